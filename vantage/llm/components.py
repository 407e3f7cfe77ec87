"""Connected components of an edge table.

Alternating large-star and small-star steps: every step links the neighbours
of a node to the smallest among them, so paths shorten and the edge count does
not grow. Each step is a grouped minimum (combined before the shuffle) and a
join back, written to the shared folder; nothing but two counters per step
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vantage.llm.shared import written


EDGES_PER_FILE = 500_000


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (u, v) of longs -> (node, root): every node of an edge with the
    smallest node of its component. Self edges are allowed; no edges give an
    empty table."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    now, mark = _kept(down.distinct(), None)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, _ = _kept(large, mark[0])
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        joined = large.join(least, F.col("u") == F.col("c"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
        before = mark
        now, mark = _kept(small.distinct(), mark[0])
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _kept(edges: DataFrame, about: int | None) -> tuple[DataFrame, tuple]:
    """The edges written, in files for ``about`` as many, with their number and
    an order-free checksum taken on the way."""
    seen = Observation()
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    watched = edges.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("h"))
    if about is not None:
        watched = watched.coalesce(about // EDGES_PER_FILE + 6)
    out = written(watched, "cc")
    return out, (seen.get["n"], seen.get["h"])
