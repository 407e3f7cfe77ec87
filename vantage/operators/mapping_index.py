"""Mapping-side operators: grouped index, balanced buckets, smoke subset,
representative images."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.constants import SMOKE_MAX_IMAGES, SMOKE_MAX_VIEWPOINTS
from vantage.operators.ranking import ordered_lists, rank_within_groups


def image_sort_key(image_id: str | Column, seq: str | Column | None = None) -> list[Column]:
    """Numeric-aware order of image ids: all-digit ids first by value, then
    text; equal keys keep their row order."""
    c = F.col(image_id) if isinstance(image_id, str) else image_id
    digits = c.rlike("^[0-9]+$")
    stripped = F.regexp_replace(c, "^0+(?=.)", "")  # numeric order of any length
    key = [
        F.when(digits, F.lit(0)).otherwise(F.lit(1)),
        F.when(digits, F.length(stripped)),
        F.when(digits, stripped),
        F.when(~digits, c),
    ]
    if seq is not None:
        key.append(F.col(seq) if isinstance(seq, str) else seq)
    return key


def viewpoint_sizes(mapping: DataFrame) -> DataFrame:
    return mapping.groupBy("viewpoint_id").agg(F.count(F.lit(1)).alias("image_count"))


def mapping_ranks(mapping: DataFrame) -> DataFrame:
    """Mapping rows with their place in their viewpoint's ordered image list:
    (viewpoint_id, position, image_id). The form for viewpoints of any size."""
    m = mapping.select("viewpoint_id", "image_id", *(["seq"] if "seq" in mapping.columns else []))
    order = image_sort_key("image_id", "seq" if "seq" in m.columns else None)
    keyed = m.select("viewpoint_id", "image_id", *[o.alias(f"_k{i}") for i, o in enumerate(order)])
    ranked = rank_within_groups(keyed, ["viewpoint_id"], [f"_k{i}" for i in range(len(order))], out="position")
    return ranked.select("viewpoint_id", "position", "image_id")


def grouped_mapping(mapping: DataFrame) -> DataFrame:
    """viewpoint -> (image_count, ordered image ids), duplicates kept: one row
    per viewpoint."""
    lists = ordered_lists(mapping_ranks(mapping), ["viewpoint_id"], "image_id", "position", "image_ids")
    return lists.select("viewpoint_id", F.size("image_ids").cast("long").alias("image_count"), "image_ids")


# --- balanced buckets -----------------------------------------------------

def _fill_size(loads: np.ndarray, size: int, count: int) -> np.ndarray:
    """How many of ``count`` equal items of ``size`` greedy puts in each bucket.

    Greedy sends each item to the lightest bucket (lowest id on ties). Items
    of one size are interchangeable, so the result is the ``count`` smallest
    pairs (loads[b] + k*size, b), k >= 0: find the level lam where the number
    of pairs below it reaches ``count``, then take ties at lam by bucket id.
    """
    lo, hi = int(loads.min()), int(loads.min()) + size * count
    while lo < hi:  # smallest lam with #pairs <= lam >= count
        mid = (lo + hi) // 2
        n_le = np.where(loads <= mid, (mid - loads) // size + 1, 0).sum()
        if n_le >= count:
            hi = mid
        else:
            lo = mid + 1
    lam = lo
    below = np.where(loads < lam, (lam - loads + size - 1) // size, 0)
    rest = count - int(below.sum())
    at_lam = (loads <= lam) & ((lam - loads) % size == 0)
    extra = np.zeros_like(below)
    idx = np.flatnonzero(at_lam)[:rest]
    extra[idx] = 1
    return below + extra


def bucket_plan(histogram: list[tuple[int, int]], num_buckets: int) -> pd.DataFrame:
    """Fold the (size, #viewpoints) histogram, largest size first, into rows
    (image_count, bucket_id, load, n): the bucket has ``load`` images before
    that size and gets n viewpoints of it. Rows with n = 0 are left out, so
    there are at most as many rows as viewpoints, and numbers only."""
    loads = np.zeros(num_buckets, dtype=np.int64)
    parts: list[tuple[np.ndarray, ...]] = []
    for size, count in sorted(histogram, key=lambda r: -r[0]):
        n = _fill_size(loads, int(size), int(count))
        b = np.flatnonzero(n)
        parts.append((np.full(len(b), size, np.int64), b.astype(np.int32), loads[b], n[b].astype(np.int64)))
        loads += n * int(size)
    names = ("image_count", "bucket_id", "load", "n")
    types = (np.int64, np.int32, np.int64, np.int64)
    return pd.DataFrame({c: np.concatenate([np.zeros(0, t), *(p[k] for p in parts)]) for k, (c, t) in enumerate(zip(names, types))})


def bucket_assignment(mapping: DataFrame, num_buckets: int) -> DataFrame:
    """Greedy balanced buckets, exactly as the sequential rule: viewpoints by
    image count desc (ties: viewpoint asc), each into the currently lightest
    bucket (ties: lowest bucket id).

    Spark builds the size histogram; only that histogram (at most
    sqrt(2 * images) distinct sizes) is folded on the driver into a per-size
    bucket plan. Spark then ranks viewpoints inside each size by id, expands
    the plan into (size, rank) -> bucket slots ranked by (load, bucket), and
    joins the two on (size, rank).
    """
    if num_buckets <= 0:
        raise ValueError(f"{num_buckets} buckets cannot hold anything")
    return assign_sizes(viewpoint_sizes(mapping), num_buckets)


def assign_sizes(sizes: DataFrame, num_buckets: int) -> DataFrame:
    """``bucket_assignment`` over (viewpoint_id, image_count); read twice."""
    if num_buckets <= 0:
        raise ValueError(f"{num_buckets} buckets cannot hold anything")
    spark = sizes.sparkSession
    hist = [(r["image_count"], r["n"]) for r in
            sizes.groupBy("image_count").agg(F.count(F.lit(1)).alias("n")).collect()]
    plan_df = spark.createDataFrame(bucket_plan(hist, num_buckets), "image_count long, bucket_id int, load long, n long")
    slots = plan_df.select(
        "image_count", "bucket_id", "load",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"),
    ).select("image_count", "bucket_id", (F.col("load") + F.col("k") * F.col("image_count")).alias("slot_load"))
    slots = rank_within_groups(slots, ["image_count"], ["slot_load", "bucket_id"], out="j")
    vps = rank_within_groups(sizes, ["image_count"], ["viewpoint_id"], out="j")
    return vps.join(slots, ["image_count", "j"]).select(
        "viewpoint_id", "bucket_id", "image_count"
    )


def bucket_members(assignment: DataFrame) -> DataFrame:
    """Viewpoints of each bucket numbered by id: (bucket_id, position,
    viewpoint_id). The form for buckets of any size."""
    rows = assignment.select("bucket_id", "viewpoint_id")
    return rank_within_groups(rows, ["bucket_id"], ["viewpoint_id"], out="position").select(
        "bucket_id", "position", "viewpoint_id"
    )


def bucket_totals(assignment: DataFrame, num_buckets: int) -> DataFrame:
    """(bucket_id, viewpoint_count, image_count), empty buckets with 0."""
    buckets = assignment.sparkSession.range(num_buckets).select(F.col("id").cast("int").alias("bucket_id"))
    totals = assignment.groupBy("bucket_id").agg(
        F.count(F.lit(1)).alias("viewpoint_count"), F.sum("image_count").alias("image_count")
    )
    zero = F.lit(0).cast("long")
    return buckets.join(totals, "bucket_id", "left").select(
        "bucket_id", F.coalesce("viewpoint_count", zero).alias("viewpoint_count"), F.coalesce("image_count", zero).alias("image_count"))


def bucket_summary(assignment: DataFrame, num_buckets: int) -> DataFrame:
    """Per bucket: viewpoint count, image count, sorted viewpoint ids; empty
    buckets are kept with 0 and an empty list."""
    lists = ordered_lists(bucket_members(assignment), ["bucket_id"], "viewpoint_id", "position", "viewpoint_ids")
    empty = F.array().cast(T.ArrayType(T.LongType()))
    return bucket_totals(assignment, num_buckets).join(lists, "bucket_id", "left").withColumn(
        "viewpoint_ids", F.coalesce("viewpoint_ids", empty))


def smoke_subset(mapping: DataFrame, max_viewpoints: int = SMOKE_MAX_VIEWPOINTS,
                 max_images: int = SMOKE_MAX_IMAGES) -> DataFrame:
    """Rows of the first ``max_viewpoints`` distinct viewpoints (by first
    appearance), then the first ``max(1, max_images)`` of those rows in order."""
    if max_viewpoints <= 0:
        return mapping.limit(0).select("image_id", "viewpoint_id", "seq")
    firsts = mapping.groupBy("viewpoint_id").agg(F.min("seq").alias("_first"))
    chosen = firsts.orderBy("_first").limit(int(max_viewpoints)).select("viewpoint_id")
    rows = mapping.join(F.broadcast(chosen), "viewpoint_id", "left_semi")
    return rows.orderBy("seq").limit(max(1, int(max_images))).select("image_id", "viewpoint_id", "seq")


def representative_image(mapping: DataFrame) -> DataFrame:
    """First image of each viewpoint in mapping order."""
    return mapping.groupBy("viewpoint_id").agg(
        F.min_by("image_id", "seq").alias("image_id"), F.min("seq").alias("seq")
    )


def with_buckets(df: DataFrame, assignment: DataFrame, repartition: bool = False) -> DataFrame:
    """Attach ``bucket_id`` to any viewpoint-keyed table; optionally lay it out
    by bucket and viewpoint. Ranges of (bucket, viewpoint) are cut by row
    count, so buckets don't share partitions by chance, and a bucket larger
    than a partition spans several. To store buckets apart, write with
    ``partitionBy("bucket_id")``.
    """
    out = df.join(assignment.select("viewpoint_id", "bucket_id"), "viewpoint_id", "left")
    return out.repartitionByRange("bucket_id", "viewpoint_id") if repartition else out
