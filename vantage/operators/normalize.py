"""Typed image / annotation / category tables from raw exploded rows.

Every cast is a ``try_cast``: a value the application would have turned into
null (non-ANSI casts) stays null here instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions import bbox_area, file_stem, to_integer

SPLIT_RANK = {"train": 0, "val": 1}


def split_rank(split: F.Column) -> F.Column:
    """Order of the splits: train, val, then any other name."""
    expr = F.lit(len(SPLIT_RANK))
    for name, rank in reversed(list(SPLIT_RANK.items())):
        expr = F.when(split == name, F.lit(rank)).otherwise(expr)
    return expr


def _split_cols(df: DataFrame) -> list[str]:
    return ["split"] if "split" in df.columns else []


def normalize_images(raw: DataFrame) -> DataFrame:
    out = raw.select(
        *_split_cols(raw),
        F.col("pos").cast("long").alias("pos"),
        to_integer("id").alias("coco_image_id"),
        F.col("file_name").cast("string").alias("file_name"),
        F.col("width").try_cast("double").alias("width"),
        F.col("height").try_cast("double").alias("height"),
    )
    return out.withColumn("image_area", F.col("width") * F.col("height")).withColumn(
        "image_id", file_stem("file_name")
    )


def normalize_annotations(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        *_split_cols(raw),
        F.col("pos").cast("long").alias("pos"),
        to_integer("id").alias("annotation_id"),
        to_integer("image_id").alias("coco_image_id"),
        to_integer("category_id").alias("category_id"),
        F.col("area").try_cast("double").alias("_area"),
        F.transform("bbox", lambda x: x.try_cast("double")).alias("bbox"),
    )
    return typed.withColumn("bbox_area", bbox_area("_area", "bbox")).drop("_area")


def normalize_categories(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_split_cols(raw),
        F.col("pos").cast("long").alias("pos"),
        to_integer("id").alias("category_id"),
        F.col("name").cast("string").alias("category_name"),
    )


def distinct_categories(categories: DataFrame) -> DataFrame:
    """One name per category id. On conflicting names the train split wins,
    then document order."""
    rank = split_rank(F.col("split")) if "split" in categories.columns else F.lit(0)
    return categories.groupBy("category_id").agg(
        F.min_by("category_name", F.struct(rank, F.col("pos"))).alias("category_name")
    )


def union_splits(*frames: DataFrame) -> DataFrame:
    """Union all by column name (train first)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
