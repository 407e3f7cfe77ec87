"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. AQE stays on: it coalesces small shuffle
# partitions, turns joins into broadcasts from runtime sizes and splits skewed
# join partitions, so the fixed partition count only has to be an upper bound.
# Broadcasts are decided only on measured sizes: the planner's static guess
# (compressed file size scaled by column widths) once chose to broadcast the
# annotation fact table, so static broadcasting is off and AQE converts a join
# after its shuffle stages report the real size of each side. Explicit
# broadcast hints are placed only behind a row-count check.
BASE_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesced partitions may go down to 256 KB: keeps CPU-heavy stages over
    # small shuffles parallel; large inputs are far above either floor.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange: where an
    # aggregate uses the join's own partitioning, AQE would otherwise leave it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when the driver forgets the table they belong to.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "vantage",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    default_parallelism: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if default_parallelism:
        conf["spark.default.parallelism"] = str(default_parallelism)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts and job state.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (local tests) is ``fallback`` (or a fresh folder under /tmp) installed. A
    cluster without the setting is an error: executors share no local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    installed = spark.sparkContext.getCheckpointDir()
    if configured and not installed:
        # named by the cluster but not yet installed on this context
        spark.sparkContext.setCheckpointDir(configured)
    configured = configured or installed
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[[^]]*\])?$", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set and {master} has no folder that all executors share")
    root = fallback or os.path.join("/tmp", f"vantage-ckpt-{uuid.uuid4().hex[:8]}")
    spark.sparkContext.setCheckpointDir(root)
    return root


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Scratch tables of this process, for ``free_scratch``.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """A write inside drops its shuffle files when it ends. Else they stay until
    the driver's JVM collects the plan, which may be never in a short job."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def free_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Empties the scratch tables at ``paths``, by default all that this process
    has asked for so far; returns how many. For tables that no lazy result
    reads any more, at the end of a job or before."""
    paths, none = list(_SCRATCH) if paths is None else paths, spark.createDataFrame([], "gone int")
    for path in paths:
        none.write.mode("overwrite").parquet(path)
        _SCRATCH.remove(path)
    return len(paths)
