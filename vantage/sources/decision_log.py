"""Review decisions as an append-only log with a compacted snapshot.

    <path>/events/g=<n>/   appended: one small file per call of ``record``
    <path>/snapshot/       a versioned table: the latest decision of each pair

Recording costs one small file, whatever was decided before. Every row, in the
snapshot too, carries the time it was recorded, and reading takes each pair's
newest row over both, so it makes no difference whether a row is in one of them
or in both. ``compact`` saves that result as the next snapshot. Events go to the
generation named by the newest snapshot; reading takes that generation and the
one before, since a row may have been on its way while a snapshot was saved.
Until the snapshot's commit record is there, the old one with its generations
stays in force: a crash at any moment loses nothing.
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.operators.review import DECISIONS, apply_decisions
from vantage.sources.versions import expire_versions, latest_version, read_version, save_version

EVENTS = "viewpoint_id_a long, viewpoint_id_b long, merge_decision string, notes string, event_seq struct<at: long, n: long>"


def record(spark: SparkSession, path: str, decisions: Iterable[tuple[int, int, str, str]]) -> int:
    """Appends (viewpoint_id_a, viewpoint_id_b, decision, notes) rows; a later
    one of a pair wins. An empty decision takes a pair's decision back."""
    rows = []
    at = time.time_ns()
    for n, (a, b, decision, notes) in enumerate(decisions):
        if decision not in (*DECISIONS, ""):
            raise ValueError(f"unknown decision {decision!r}: one of {', '.join(DECISIONS)} or empty")
        if a is None or b is None or int(a) >= int(b):
            raise ValueError(f"a pair is two viewpoint ids in ascending order, not {a}, {b}")
        rows.append((int(a), int(b), decision, notes or "", (at, n)))
    if rows:
        frame = spark.createDataFrame(rows, EVENTS)
        frame.coalesce(1).write.mode("append").parquet(f"{path}/events/g={_generation(spark, path)}")
    return len(rows)


def record_all(decisions: DataFrame, path: str, order: str = "seq") -> None:
    """Appends a table of decisions (a whole events file), later ``order`` wins."""
    spark = decisions.sparkSession
    at = F.struct(F.lit(time.time_ns()).cast("long").alias("at"), F.col(order).cast("long").alias("n")).alias("event_seq")
    known = F.coalesce("merge_decision", F.lit(""))
    checked = F.when(known.isin(*DECISIONS, ""), known).otherwise(F.raise_error(F.concat(F.lit("unknown decision "), known)))
    rows = decisions.select(
        F.col("viewpoint_id_a").cast("long"), F.col("viewpoint_id_b").cast("long"),
        checked.alias("merge_decision"), F.coalesce("notes", F.lit("")).alias("notes"), at)
    rows.write.mode("append").parquet(f"{path}/events/g={_generation(spark, path)}")


def _generation(spark: SparkSession, path: str) -> int:
    at = latest_version(spark, f"{path}/snapshot")
    return at.version if at else 0


def latest_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Each pair's newest row: viewpoint_id_a, viewpoint_id_b, merge_decision,
    notes, event_seq. An empty log gives an empty table."""
    at = latest_version(spark, f"{path}/snapshot")
    rows = read_version(spark, f"{path}/snapshot", at) if at else spark.createDataFrame([], EVENTS)
    now = at.version if at else 0
    for g in range(max(0, now - 1), now + 1):
        try:
            rows = rows.unionByName(spark.read.schema(EVENTS).parquet(f"{path}/events/g={g}"))
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
    newest = F.max_by(F.struct("merge_decision", "notes", "event_seq"), "event_seq").alias("d")
    return rows.groupBy("viewpoint_id_a", "viewpoint_id_b").agg(newest).select("viewpoint_id_a", "viewpoint_id_b", "d.*")


def compact(spark: SparkSession, path: str) -> int:
    """Saves the newest row of each pair as the next snapshot; returns its
    number. Generations that no reader takes any more are emptied."""
    saved = save_version(latest_decisions(spark, path), f"{path}/snapshot")
    expire_versions(spark, f"{path}/snapshot", 2)
    if saved.version >= 3:
        spark.createDataFrame([], EVENTS).write.mode("overwrite").parquet(f"{path}/events/g={saved.version - 3}")
    return saved.version


def decided(candidates: DataFrame, path: str) -> DataFrame:
    """The candidate rows with the log's decisions; pairs without one keep theirs."""
    return apply_decisions(candidates, latest_decisions(candidates.sparkSession, path), keep=True)


def unknown_pairs(candidates: DataFrame, path: str) -> DataFrame:
    """Logged pairs that are no candidate (should be empty)."""
    keys = ["viewpoint_id_a", "viewpoint_id_b"]
    return latest_decisions(candidates.sparkSession, path).select(*keys).join(candidates.select(*keys), keys, "left_anti")
