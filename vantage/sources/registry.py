"""Viewpoint registry: (viewpoint_id, centroid, count) and ``last_index``,
the number of dataset rows it covers. Kept as versions, see ``versions``: the
viewpoints are a version's rows and ``last_index`` is in its commit record, so
the two can't come apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions import l2_normalize
from vantage.operators.checks import check_registry, enforce
from vantage.schemas import REGISTRY
from vantage.sources.versions import Version, expire_versions, latest_version, read_version, save_version, versions

KEEP_VERSIONS = 2


def load_registry(spark: SparkSession, path: str, dim: int, missing_ok: bool = True, version: int | None = None
                  ) -> tuple[DataFrame, int]:
    """Validated registry with unit centroids, and its ``last_index``: the
    newest version, or the one asked for.

    A missing registry is empty with last_index 0 when ``missing_ok``.
    """
    known = versions(spark, path)
    at = known[-1] if known and version is None else next((v for v in known if v.version == version), None)
    if at is None:
        if missing_ok and not known and version is None:
            return spark.createDataFrame([], REGISTRY), 0
        raise FileNotFoundError(f"{path}: no {'registry' if version is None else f'version {version}'}")
    reg = read_version(spark, path, at)
    last_index = int(at.facts["last_index"])
    enforce(check_registry(reg, dim, last_index), f"{path}: unsound registry")
    return reg.select("viewpoint_id", l2_normalize("centroid").alias("centroid"), "count"), last_index


def save_registry(registry: DataFrame, path: str, last_index: int, keep: int = KEEP_VERSIONS) -> Version:
    """Saves the next version; ``registry`` may come from an older one. The
    newest ``keep`` versions stay readable, and one more that a reader may have
    opened meanwhile."""
    if last_index < 0:
        raise ValueError(f"negative last_index {last_index}")
    rows = registry.select("viewpoint_id", F.col("centroid").cast("array<double>").alias("centroid"), "count")
    saved = save_version(rows, path, {"last_index": int(last_index)})
    expire_versions(registry.sparkSession, path, keep + 1)
    return saved


def registry_version(spark: SparkSession, path: str) -> int:
    """The newest version's number, 0 where nothing is saved."""
    at = latest_version(spark, path)
    return at.version if at else 0


def registry_totals(registry: DataFrame) -> DataFrame:
    """Number of viewpoints and the images they hold."""
    return registry.agg(F.count(F.lit(1)).alias("viewpoints"),
                        F.coalesce(F.sum("count"), F.lit(0)).alias("images"))
