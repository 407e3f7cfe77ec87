"""Image-to-viewpoint mapping sources and the ordered-row helper."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vantage.functions import to_integer
from vantage.operators.util import broadcast_if_small

MAPPING_COLUMNS = ["image_id", "viewpoint_id"]


class MappingSchemaError(ValueError):
    pass


def with_file_order(df: DataFrame) -> DataFrame:
    """Attach ``seq``: a dense 0-based row number in file order.

    Rows inside one file split keep their order and splits are ordered by
    (file path, split start); per-split counts are prefix-summed on a table
    with one row per split, so no single task sees all rows.
    """
    keyed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mono"),
    )
    return dense_sequence(keyed, ["_file", "_block"], "_mono").drop("_file", "_block", "_mono")


def dense_sequence(df: DataFrame, group_cols: list[str], order_col: str, out: str = "seq") -> DataFrame:
    """Dense global row number over the order (group_cols..., order_col).

    Rank within each group (groups are file splits, bounded in size), then add
    the group's offset from a running sum over the per-group counts.
    """
    counts = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n"))
    w_all = Window.orderBy(*group_cols).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, F.coalesce(F.sum("_n").over(w_all), F.lit(0)).alias("_off"))
    w_grp = Window.partitionBy(*group_cols).orderBy(order_col)
    ranked = df.withColumn("_rn", F.row_number().over(w_grp))
    return (
        ranked.join(broadcast_if_small(offsets), group_cols)
        .withColumn(out, (F.col("_off") + F.col("_rn") - 1).cast("long"))
        .drop("_off", "_rn")
    )


def read_mapping_csv(spark: SparkSession, path: str, ordered: bool = True) -> DataFrame:
    """Lenient mapping read: select the two columns by header name, cast,
    drop rows whose key or viewpoint is null or not a number."""
    raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    missing = [c for c in MAPPING_COLUMNS if c not in raw.columns]
    if missing:
        raise MappingSchemaError(f"{path}: image_id and viewpoint_id are both needed, found {raw.columns}")
    if ordered:
        raw = with_file_order(raw)
    out = raw.select(
        F.col("image_id").cast("string").alias("image_id"),
        to_integer("viewpoint_id").alias("viewpoint_id"),
        *(["seq"] if ordered else []),
    )
    return out.dropna(subset=["image_id", "viewpoint_id"])


def read_mapping_strict(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Strict mapping read: header must be exactly ``image_id,viewpoint_id``;
    a bad viewpoint id raises (ANSI cast). A missing file is an empty mapping
    when ``missing_ok`` (resume), else an error."""
    from pyspark.errors import AnalysisException

    from vantage.schemas import MAPPING

    try:
        raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        if missing_ok:
            return spark.createDataFrame([], MAPPING)
        raise FileNotFoundError(f"{path}: there is no mapping") from exc
    if raw.columns != MAPPING_COLUMNS:
        raise MappingSchemaError(f"{path}: the header must be exactly {MAPPING_COLUMNS}")
    return with_file_order(raw).select(
        F.col("image_id").cast("string"),
        F.col("viewpoint_id").cast("long"),
        "seq",
    )


def read_mapping_trimmed(spark: SparkSession, path: str) -> DataFrame:
    """Mapping read that trims both values and fails on a non-integer id."""
    raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    if not set(MAPPING_COLUMNS).issubset(raw.columns):
        raise MappingSchemaError(f"{path}: image_id and viewpoint_id are both needed, found {raw.columns}")
    return with_file_order(raw).select(
        F.trim(F.col("image_id")).alias("image_id"),
        F.trim(F.col("viewpoint_id")).cast("long").alias("viewpoint_id"),
        "seq",
    )
