"""Explicit schemas. Nothing is inferred: inference makes optional COCO fields
fatal (an absent ``area`` key, an empty ``categories`` array) and costs a
job per file."""

from pyspark.sql import types as T

# Numbers of COCO documents are read as text and cast in operators.normalize:
# documents write ids as numbers or as strings.
COCO_IMAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("width", T.StringType()),
    T.StructField("height", T.StringType()),
])

COCO_ANNOTATION = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("image_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("bbox", T.ArrayType(T.StringType())),
])

COCO_CATEGORY = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
])

COCO_DOCUMENT = T.StructType([
    T.StructField("images", T.ArrayType(COCO_IMAGE)),
    T.StructField("annotations", T.ArrayType(COCO_ANNOTATION)),
    T.StructField("categories", T.ArrayType(COCO_CATEGORY)),
])

# Raw mapping CSV: read as text, cast afterwards (bad values become null).
MAPPING_CSV = T.StructType([
    T.StructField("image_id", T.StringType()),
    T.StructField("viewpoint_id", T.StringType()),
])

MAPPING = T.StructType([
    T.StructField("image_id", T.StringType()),
    T.StructField("viewpoint_id", T.LongType()),
    T.StructField("seq", T.LongType()),
])

METRIC_NUMERIC_COLUMNS = (
    "viewpoint_id",
    "total_images",
    "total_vehicles",
    "avg_vehicle_count",
    "per_vehicle_count",
    "avg_bbox_density",
    "heavy_vehicle_ratio",
    "two_wheeler_ratio",
    "entropy",
    "congestion_index",
)

METRIC_COLUMNS = METRIC_NUMERIC_COLUMNS + ("class_distribution_vector",)

VIEWPOINT_METRICS = T.StructType([
    T.StructField("viewpoint_id", T.LongType()),
    T.StructField("total_images", T.LongType()),
    T.StructField("total_vehicles", T.LongType()),
    T.StructField("avg_vehicle_count", T.DoubleType()),
    T.StructField("per_vehicle_count", T.DoubleType()),
    T.StructField("avg_bbox_density", T.DoubleType()),
    T.StructField("heavy_vehicle_ratio", T.DoubleType()),
    T.StructField("two_wheeler_ratio", T.DoubleType()),
    T.StructField("entropy", T.DoubleType()),
    T.StructField("congestion_index", T.DoubleType()),
    T.StructField("class_distribution_vector", T.StringType()),
])

# Metrics JSONL as written by other tools: every field read as text so that a
# bad value degrades to null instead of failing the whole file.
METRICS_JSONL_TEXT = T.StructType(
    [T.StructField(c, T.StringType()) for c in METRIC_COLUMNS]
)

PAIR_COLUMNS = (
    "viewpoint_id_a",
    "image_id_a",
    "image_path_a",
    "viewpoint_id_b",
    "image_id_b",
    "image_path_b",
    "centroid_similarity",
    "merge_decision",
    "notes",
)

PAIR_CSV = T.StructType([T.StructField(c, T.StringType()) for c in PAIR_COLUMNS])

REGISTRY = T.StructType([
    T.StructField("viewpoint_id", T.LongType()),
    T.StructField("centroid", T.ArrayType(T.FloatType())),
    T.StructField("count", T.LongType()),
])
