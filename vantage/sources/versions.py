"""Tables kept as versions, so that a save never touches what readers use.

    <path>/log/            JSON lines, only ever appended: what became of each folder
    <path>/data/<folder>/  Parquet, written once

A save first logs ``begin`` with a fresh folder, writes the rows there, and
appends ``commit`` with the version and its facts as the last step. That record
is one file that appears whole, so a crash at any earlier moment leaves the
version before it in force, and a reader sees one version or the next. Rows may
come from an older version of the same table. ``expire_versions`` empties the
folders of old versions and of saves that never committed.

Saves are meant to come from one writer at a time. A writer that finds a newer
version than the one it began with gives up; should two commits get the same
number all the same, every reader takes the one with the smaller folder name
and the other writer is told.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

LOG = "event string, version long, folder string, schema string, facts string"


class SaveConflict(RuntimeError):
    pass


class Version(NamedTuple):
    version: int
    folder: str
    schema: str
    facts: dict


def _append(spark: SparkSession, path: str, event: str, version: int, folder: str, schema: str = "", facts: dict | None = None) -> None:
    row = [(event, version, folder, schema, json.dumps(facts or {}))]
    spark.createDataFrame(row, LOG).coalesce(1).write.mode("append").json(f"{path}/log")


def _history(spark: SparkSession, path: str) -> list:
    """The log: a few short rows per save."""
    try:
        return spark.read.schema(LOG).option("mode", "FAILFAST").json(f"{path}/log").collect()
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            return []
        raise


def versions(spark: SparkSession, path: str) -> list[Version]:
    """Committed versions that are not expired, oldest first."""
    rows = _history(spark, path)
    gone = {r.folder for r in rows if r.event == "expire"}
    found: dict[int, Version] = {}
    for r in sorted((r for r in rows if r.event == "commit"), key=lambda r: (r.version, r.folder)):
        found.setdefault(r.version, Version(r.version, r.folder, r.schema, json.loads(r.facts)))
    return [v for _, v in sorted(found.items()) if v.folder not in gone]


def latest_version(spark: SparkSession, path: str) -> Version | None:
    known = versions(spark, path)
    return known[-1] if known else None


def read_version(spark: SparkSession, path: str, at: Version) -> DataFrame:
    return spark.read.schema(at.schema).parquet(f"{path}/data/{at.folder}")


def save_version(df: DataFrame, path: str, facts: dict | None = None) -> Version:
    """Writes ``df`` as the next version; ``facts`` (plain JSON values) go into
    its commit record."""
    spark = df.sparkSession
    before = latest_version(spark, path)
    number = before.version + 1 if before else 1
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    new = Version(number, f"v{number:010d}-{uuid.uuid4().hex}", schema, facts or {})
    _append(spark, path, "begin", number, new.folder)
    df.write.parquet(f"{path}/data/{new.folder}")
    now = latest_version(spark, path)
    if (now.version if now else 0) != number - 1:
        raise SaveConflict(f"{path}: version {now.version} was saved meanwhile")
    _append(spark, path, "commit", number, new.folder, new.schema, new.facts)
    mine = [v for v in versions(spark, path) if v.version == number]
    if mine and mine[0].folder != new.folder:
        raise SaveConflict(f"{path}: another writer saved version {number}")
    return new


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Empties all folders but those of the ``keep`` newest versions and of a
    save that may still be running; returns how many were emptied."""
    known = versions(spark, path)
    if not known:
        return 0
    stay = {v.folder for v in known[-max(1, keep):]}
    rows = _history(spark, path)
    done = {r.folder for r in rows if r.event == "emptied"}
    old = sorted({(r.folder, r.version) for r in rows if r.event == "begin" and r.version <= known[-1].version and r.folder not in stay | done})
    for folder, number in old:
        _append(spark, path, "expire", number, folder)  # readers stop first
        spark.createDataFrame([], "gone int").write.mode("overwrite").parquet(f"{path}/data/{folder}")
        _append(spark, path, "emptied", number, folder)
    return len(old)
