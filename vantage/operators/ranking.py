"""Ranks and lists inside groups that may be arbitrarily large.

A window partitioned by the group key puts a whole group into one task; a
group holding a third of all rows would then run on one core. Instead rows
are range-partitioned and sorted on (group, order) so a large group spans
many partitions; the sorted table is checkpointed (this freezes each row's
partition id and position); each row's rank is its position inside its
partition plus the row counts of the same group in earlier partitions. The
offset table has one row per (partition, group) pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.operators.util import broadcast_if_small
from vantage.session import checkpoint_root, scratch_path


def rank_within_groups(df: DataFrame, group_cols: list[str], order_cols: list[str | Column],
                       out: str = "rank") -> DataFrame:
    """0-based rank of each row inside its group; ``order_cols`` must make the
    order total within a group."""
    checkpoint_root(df.sparkSession)
    keys = [*group_cols, *order_cols]
    ordered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_pos"))
    )
    frozen = ordered.checkpoint(eager=True)
    stats = frozen.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first")
    )
    spec = Window.partitionBy(*group_cols) if group_cols else Window
    before = spec.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select("_pid", *group_cols, "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (
        frozen.join(broadcast_if_small(offsets), ["_pid", *group_cols])
        .withColumn(out, (F.col("_pos") - F.col("_first") + F.col("_off")).cast("long"))
        .drop("_pid", "_pos", "_first", "_off")
    )


def rank_mostly_small(df: DataFrame, group_cols: list[str], order_cols: list[str | Column], out: str = "rank",
                      most: int = 100_000) -> DataFrame:
    """``rank_within_groups`` for groups that are nearly all small: a window
    inside each group of at most ``most`` rows (one exchange, nothing written),
    the distributed rank only for the groups above that."""
    spark = df.sparkSession
    large = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(*group_cols)
    path = scratch_path(spark, "large-groups")
    large.write.parquet(path)
    large = spark.read.schema(large.schema).parquet(path)
    inside = Window.partitionBy(*group_cols).orderBy(*order_cols)
    number = (F.row_number().over(inside) - 1).cast("long")
    if large.isEmpty():
        return df.withColumn(out, number)
    large = broadcast_if_small(large)
    small = df.join(large, group_cols, "left_anti").withColumn(out, number)
    ranked = rank_within_groups(df.join(large, group_cols, "left_semi"), group_cols, order_cols, out)
    return small.unionByName(ranked)


def ordered_lists(ranked: DataFrame, group_cols: list[str], value: str, rank: str = "rank",
                  out: str = "values") -> DataFrame:
    """The values of each group as one array in rank order: one row per group,
    whatever its size. For outputs whose format is a list per row; groups that
    may outgrow a row are kept as the ranked rows themselves."""
    return ranked.groupBy(*group_cols).agg(
        F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(value).alias("v")))).alias("_l")
    ).select(*group_cols, F.transform("_l", lambda e: e["v"]).alias(out))
