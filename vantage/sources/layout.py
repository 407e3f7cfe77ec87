"""Tables laid out by key, so that joins on it need no exchange.

``write_clustered`` stores a table in ``buckets`` hash buckets of its key,
sorted inside each file. Tables of the same bucket count and key then join, and
group by that key, where they lie. A key's rows share a bucket, which one task
writes and reads, so keys of very many rows (``hot_keys``) need another place.

``write_parts`` gives them one: rows of hot keys stay in as many plain files as
there were tasks, all others go to buckets. ``join_parts`` joins buckets with
buckets where they lie, and streams the hot rows past the other table's rows of
these keys. Both tables must be written with the same list of hot keys
(``hot_keys_of``); a key then stands in one part only, so work by key can run on
each part by itself. A null key is a key like others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.operators.util import broadcast_if_small

LEAST_SHARE = 0.001  # of a hot key: the list of hot keys stays short


def write_clustered(df: DataFrame, path: str, key: str, buckets: int, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes ``df`` at ``path`` and returns it as a table of the session's
    catalog, which holds the layout. One task writes a bucket, so a bucket is
    one file and its order is known to the reader."""
    name = f"clustered_{uuid.uuid4().hex[:12]}"
    rows = df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key, *sort_by).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_clustered(spark: SparkSession, path: str, schema: str, key: str, buckets: int, sort_by: tuple[str, ...] = ()) -> DataFrame:
    """A table ``write_clustered`` has written, in another session."""
    name = f"clustered_{uuid.uuid4().hex[:12]}"
    order = ", ".join(f"`{c}`" for c in (key, *sort_by))
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """(key, rows) of keys with more than ``share`` of all rows: at most 1 / share."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return counts.join(F.broadcast(total)).where(F.col("rows") > F.col("total") * share).select(key, "rows")


class Parts(NamedTuple):
    cold: DataFrame  # in buckets
    hot: DataFrame  # rows of hot keys, in plain files


def hot_keys_of(tables: list[DataFrame], key: str, share: float = 0.01) -> list[Any]:
    """Keys that are hot in any of the tables: at most 1 / share of each."""
    if share < LEAST_SHARE:
        raise ValueError(f"a share below {LEAST_SHARE} can name too many keys")
    found: list[Any] = []
    for df in tables:
        found += [r[key] for r in hot_keys(df, key, share).collect() if r[key] not in found]
    return found


def _is_hot(key: str, hot: list[Any]) -> Column:
    known = F.coalesce(F.col(key).isin([k for k in hot if k is not None]), F.lit(False))
    return known | F.col(key).isNull() if None in hot else known


def write_parts(df: DataFrame, path: str, key: str, buckets: int, hot: list[Any], sort_by: tuple[str, ...] = ()) -> Parts:
    """Writes ``df`` at ``path``/cold in buckets and ``path``/hot in the tasks
    that hold the rows, without an exchange."""
    is_hot = _is_hot(key, hot)
    cold = write_clustered(df.where(~is_hot), f"{path}/cold", key, buckets, sort_by)
    df.where(is_hot).sortWithinPartitions(key, *sort_by).write.parquet(f"{path}/hot")
    return Parts(cold, df.sparkSession.read.schema(df.schema).parquet(f"{path}/hot"))


def open_parts(spark: SparkSession, path: str, schema: str, key: str, buckets: int, sort_by: tuple[str, ...] = ()) -> Parts:
    """Parts that ``write_parts`` has written, in another session."""
    cold = open_clustered(spark, f"{path}/cold", schema, key, buckets, sort_by)
    return Parts(cold, spark.read.schema(schema).parquet(f"{path}/hot"))


def join_parts(left: Parts, right: Parts, key: str, how: str = "inner", then: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``left`` joined to ``right`` on ``key``, and ``then``, which may group by
    that key, applied to each part. The hot rows of ``right`` are held by the
    tasks where they are few; else the planner joins and splits the hot keys."""
    then = then or (lambda df: df)
    cold = left.cold.join(right.cold.hint("merge"), key, how)
    hot = left.hot.join(broadcast_if_small(right.hot), key, how)
    return then(cold).unionByName(then(hot))
