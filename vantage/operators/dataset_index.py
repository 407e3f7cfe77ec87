"""The ordered image index of the stage that assigns viewpoints: dataset
order, per-image box lists, mask rectangles and file-path resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.functions import MASK_PADDING, mask_rect
from vantage.operators.normalize import split_rank
from vantage.operators.checks import check_duplicates, check_unmatched, enforce
from vantage.operators.ranking import rank_mostly_small, rank_within_groups

BBOX = T.ArrayType(T.DoubleType())


def ordered_index(images: DataFrame) -> DataFrame:
    """Images in dataset order (train then val, document order inside a
    split) with a dense 0-based ``seq``."""
    keyed = images.select("split", "pos", "image_id", "file_name", "coco_image_id",
                          split_rank(F.col("split")).alias("_rank"))
    ranked = rank_within_groups(keyed, [], ["_rank", "pos"], out="seq")
    return ranked.select("seq", "split", "image_id", "file_name", "coco_image_id")


def check_bboxes(annotations: DataFrame) -> DataFrame:
    """Annotations whose bbox is not a list of exactly 4 numbers."""
    bad = F.col("bbox").isNull() | (F.size("bbox") != 4) | F.exists("bbox", lambda x: x.isNull())
    return annotations.where(bad).select(*[c for c in ("split",) if c in annotations.columns],
                                         "annotation_id", "coco_image_id", "bbox")


def sound_boxes(annotations: DataFrame) -> DataFrame:
    """The annotations that have a box; one that is not four numbers is an error."""
    boxed = annotations.where(F.col("bbox").isNotNull())
    enforce(check_bboxes(boxed), "a box is not a list of four numbers")
    return boxed


def image_box_rows(images: DataFrame, annotations: DataFrame, strict: bool = True) -> DataFrame:
    """Boxes as rows: each image's boxes numbered from 0 in document order,
    wherever in the document they stand. The form for images of any size. In
    strict mode a box that is not four numbers is an error."""
    annotations = sound_boxes(annotations) if strict else annotations
    key = ["split", "coco_image_id"] if "split" in annotations.columns else ["coco_image_id"]
    boxes = annotations.select(*key, "pos", "annotation_id", F.col("bbox").cast(BBOX).alias("bbox"))
    ranked = rank_mostly_small(boxes, key, ["pos", "annotation_id", "bbox"], out="position")
    return images.select("split", "coco_image_id", "image_id").join(ranked, key).select(
        "split", "coco_image_id", "image_id", "position", "bbox"
    )


def image_bboxes(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """One row per image with its boxes in document order; images without
    boxes get []."""
    key = ["split", "coco_image_id"]
    boxes = image_box_rows(images, annotations).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("position", "bbox"))).alias("_l")
    ).select(*key, F.transform("_l", lambda e: e["bbox"]).alias("bboxes"))
    empty = F.array().cast(T.ArrayType(BBOX))
    return images.select(*key, "image_id").join(boxes, key, "left").select(
        *key, "image_id", F.coalesce("bboxes", empty).alias("bboxes")
    )


def mask_rects(images: DataFrame, annotations: DataFrame, padding: int = MASK_PADDING, strict: bool = True) -> DataFrame:
    """Pixel rectangles masked before embedding, one per non-empty box. In
    strict mode a box that is not four numbers is an error."""
    annotations = sound_boxes(annotations) if strict else annotations
    key = ["split", "coco_image_id"] if "split" in annotations.columns else ["coco_image_id"]
    j = annotations.select(*key, "annotation_id", "bbox").join(
        images.select(*key, "width", "height"), key
    )
    r = j.select(*key, "annotation_id", mask_rect("bbox", "width", "height", padding).alias("r"))
    return r.where(F.col("r").isNotNull()).select(*key, "annotation_id", "r.x1", "r.y1", "r.x2", "r.y2")


def split_path_lookup(files: DataFrame, split_prefixes: dict[str, str], strict: bool = True) -> DataFrame:
    """(split, basename, path) for files under '<prefix>/data/' of each split.
    A basename found twice in a split is an error in strict mode."""
    parts = []
    for split, prefix in split_prefixes.items():
        base = f"{prefix}/data/"
        parts.append(files.where(F.col("path").startswith(base)).select(
            F.lit(split).alias("split"),
            F.regexp_extract("path", r"([^/]*)$", 1).alias("basename"),
            "path",
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if strict:
        enforce(check_duplicates(out, ["split", "basename"]), "two files of one split share a name")
    return out


def resolve_paths(index: DataFrame, lookup: DataFrame, strict: bool = True) -> DataFrame:
    """Index rows with their file path. A row whose split is unknown or whose
    file is missing is an error in strict mode, else its path is null."""
    named = lookup.select("split", F.col("basename").alias("file_name"), "path")
    if strict:
        enforce(check_unmatched(index, named, ["split", "file_name"]), "image without a file")
    return index.join(named, ["split", "file_name"], "left")
