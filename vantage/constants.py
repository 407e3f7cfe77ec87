"""Each must equal the source application's value for equal
results. Everything else in the package is a parameter or our own choice."""

# Vehicle class keywords, matched as lower-case substrings of the class name.
HEAVY_VEHICLE_KEYWORDS = ("truck", "bus", "trailer", "tractor", "lorry", "tanker", "dumper")
TWO_WHEELER_KEYWORDS = (
    "bike", "motorbike", "motorcycle", "bicycle", "cycle", "scooter", "moped",
    "two wheeler", "two-wheeler",
)
# Image key from a file name: drop any directory part, then the last extension.
DIRECTORY_PATTERN = r"^.*[\\/]"
EXTENSION_PATTERN = r"\.[^\.]+$"
# Name given to annotations whose category id is unknown: prefix + id.
UNKNOWN_CATEGORY_PREFIX = "category_"
# Mask padding applied to each box before masking (negative shrinks the box).
MASK_PADDING = -40
# Length of the embeddings.
EMBEDDING_DIM = 2048
# Near-duplicate viewpoint pairs: similarity threshold and most candidates kept.
PAIR_THRESHOLD = 0.97
MAX_CANDIDATES = 2000
# Smoke subset: first viewpoints kept, most images kept.
SMOKE_MAX_VIEWPOINTS = 10
SMOKE_MAX_IMAGES = 100
# Preview of the metrics table: rows written.
PREVIEW_LIMIT = 20
# Balanced buckets: default number of node buckets.
NODE_BUCKETS = 2
