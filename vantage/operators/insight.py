"""Queries over the viewpoint metrics table: filters, KPIs, rankings,
histogram, drill-down, class-vector rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.schemas import METRIC_NUMERIC_COLUMNS, METRICS_JSONL_TEXT
from vantage.session import scratch_path

INTEGER_METRICS = ("viewpoint_id", "total_images", "total_vehicles")


def coerce_metrics(df: DataFrame) -> DataFrame:
    """Numeric metric columns to numbers (bad text -> null); absent columns are
    skipped; a null class vector becomes "{}"."""
    out = df
    for c in METRIC_NUMERIC_COLUMNS:
        if c in out.columns:
            # whole numbers may be written as 3.0 or 3e0
            number = F.col(c).try_cast("double")
            whole = F.coalesce(F.col(c).try_cast("long"), number.try_cast("long"))
            out = out.withColumn(c, whole if c in INTEGER_METRICS else number)
    if "class_distribution_vector" in out.columns:
        out = out.withColumn("class_distribution_vector",
                             F.coalesce(F.col("class_distribution_vector"), F.lit("{}")))
    return out


def read_metrics_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Metrics JSONL: blank lines skipped, a malformed line fails the read,
    an empty input is an error."""
    df = spark.read.schema(METRICS_JSONL_TEXT).option("mode", "FAILFAST").json(path)
    if df.isEmpty():
        raise ValueError(f"{path}: no metric records")
    return coerce_metrics(df)


def metrics_from_json_text(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse a column of JSON metric records (text values tolerated)."""
    parsed = lines.select(F.from_json(F.col(column), METRICS_JSONL_TEXT).alias("r")).select("r.*")
    return coerce_metrics(parsed)


def filter_metrics(df: DataFrame, min_images: int = 1, max_entropy: float = 5.0) -> DataFrame:
    """total_images >= min_images and entropy <= max_entropy (nulls drop)."""
    return df.where((F.col("total_images") >= min_images) & (F.col("entropy") <= max_entropy))


def kpi_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("viewpoints"),
        F.coalesce(F.sum("total_vehicles"), F.lit(0).cast("long")).alias("total_vehicles"),
        F.avg("congestion_index").alias("mean_congestion"),
        F.avg("avg_bbox_density").alias("mean_bbox_density"),
    )


def top_congestion(df: DataFrame, n: int = 20) -> DataFrame:
    """Top n by congestion index; ties by viewpoint id."""
    return df.orderBy(F.col("congestion_index").desc(), F.col("viewpoint_id").asc()).limit(int(n))


def congestion_histogram(df: DataFrame, bins: int = 40, column: str = "congestion_index") -> DataFrame:
    """``bins`` equal-width bins over [min, max]; the max falls in the last bin,
    a constant column puts every row in bin 1; empty bins are kept."""
    spark = df.sparkSession
    path = scratch_path(spark, "histogram")  # the input runs once; its one column is read twice
    df.select(column).write.parquet(path)
    df = spark.read.schema(df.select(column).schema).parquet(path)
    stats = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    bin_ids = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    lo, hi = stats["lo"], stats["hi"]
    if lo is None:
        counts = df.limit(0).select(F.lit(1).alias("bin"), F.lit(0).cast("long").alias("count"))
        lo = hi = 0.0
    else:
        width = hi - lo
        idx = (F.floor((F.col(column) - F.lit(lo)) * bins / F.lit(width)) + 1).cast("int") if width > 0 else F.lit(1)
        counts = (df.where(F.col(column).isNotNull())
                  .select(F.least(idx, F.lit(bins)).alias("bin"))
                  .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    step = (hi - lo) / bins
    return bin_ids.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + (F.col("bin") - 1) * F.lit(step)).alias("bin_start"),
        (F.lit(lo) + F.col("bin") * F.lit(step)).alias("bin_end"),
        F.coalesce("count", F.lit(0).cast("long")).alias("count"),
    )


def composition_view(df: DataFrame) -> DataFrame:
    """Columns behind the charts and the table of the insight page."""
    return df.select(
        "viewpoint_id", "total_images", "total_vehicles", "avg_vehicle_count", "per_vehicle_count",
        "avg_bbox_density", "heavy_vehicle_ratio", "two_wheeler_ratio", "entropy", "congestion_index",
    )


def viewpoint_ids(df: DataFrame) -> DataFrame:
    return df.select("viewpoint_id").orderBy("viewpoint_id")


def viewpoint_detail(df: DataFrame, viewpoint_id: int | None = None) -> DataFrame:
    """One viewpoint's row; by default the first id of the sorted id list."""
    if viewpoint_id is not None:
        return df.where(F.col("viewpoint_id") == F.lit(viewpoint_id))
    first = df.agg(F.min("viewpoint_id").alias("viewpoint_id"))
    return df.join(F.broadcast(first), "viewpoint_id")


CLASS_VECTOR = T.MapType(T.StringType(), T.DoubleType())


def class_vector_explode(df: DataFrame, column: str = "class_distribution_vector") -> DataFrame:
    """The JSON class vector as (viewpoint_id, class_name, share) rows; empty or
    invalid JSON gives no rows. Sort one viewpoint's rows for display."""
    parsed = df.select("viewpoint_id", F.from_json(F.col(column), CLASS_VECTOR).alias("_m"))
    return parsed.select("viewpoint_id", F.explode("_m").alias("class_name", "share"))
