"""Clusters around centroids, with drift bounds tightened by geometry.

Components become whole numbers, floor(scale * x). Rounds assign every vector
to the nearest centroid (exact squared Euclidean distance, ties to the smaller
number) and replace every centroid that has vectors by floor(sum / count).

Between rounds a vector carries its cluster, an upper bound on the distance to
that centroid and a lower bound on the distance to every other one. When
centroids move, the upper bound grows by the own centroid's drift, and the
lower bound falls by the most that any other centroid can have come closer.
Usually that is taken to be its whole drift; here it is less. All vectors of a
cluster lie in a sphere around its centroid. For a centroid that moves from p to q,

    |x - p| - |x - q| <= |p - q| * cos(angle)

where angle is seen from the middle of p and q, between the move and x (the two
distances add up to at least twice that of x from the middle). In the plane
through p, q and the sphere's centre the least angle of the whole sphere is the
centre's angle less asin(radius / distance), so the cosine there bounds the
loss; a centroid that moves away from the sphere costs nothing.

A vector whose upper bound is below its lower bound keeps its cluster unseen;
the bounds carry a margin, and equality never counts. Otherwise its own
distance is taken exactly, and if that does not settle it, all distances.

Each round writes the vectors with their bounds to the shared folder, and a
task passes on one row per centroid and component.

Defined results: vectors that are null, hold null or non-finite components, or
have another number of components are left out; fewer kept vectors than
centroids give that many centroids; null ids come last in the choice of the
first centroids; repeated rows each count and get a row; an empty table gives
an empty result; a component too large for exact squared distances in 64 bits
is an error; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.shared import written
from vantage.llm.vectors import doubles, finite, largest_whole, matrix, whole_numbers

MARGIN = 1e-9


@dataclass(frozen=True)
class ClusterConfig:
    centroids: int = 16
    rounds: int = 3
    components: int = 64
    scale: int = 64
    seed: str = "1"
    rows_at_once: int = 8192


STATE = "vec_id long, v array<double>, cluster int, upper double, lower double, distance long, scanned boolean"


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``c``."""
    most = max(np.abs(x).max(initial=0), np.abs(c).max(initial=0))
    if 4.0 * most * most * x.shape[1] < 2.0**53:  # every sum is a whole number that a double holds
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        out = (xf * xf).sum(axis=1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(axis=1)
        return out.astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)


def losses(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[i, j]: the most by which the distance to centroid j can have fallen
    for a vector within ``radius[i]`` of the old centroid i."""
    p, q = old.astype(np.float64), new.astype(np.float64)
    drift = np.sqrt(((q - p) ** 2).sum(axis=1))
    out = np.zeros((len(p), len(p)))
    for j in np.flatnonzero(drift > 0):
        away = p - (p[j] + q[j]) / 2
        far = np.sqrt((away**2).sum(axis=1))
        along = away @ ((q[j] - p[j]) / drift[j])
        outside = far > radius * (1 + MARGIN) + MARGIN  # else the middle lies in the sphere
        angle = np.arccos(np.clip(along / np.maximum(far, MARGIN), -1, 1))
        spread = np.arcsin(np.clip((radius + MARGIN) / np.maximum(far, MARGIN), 0, 1))
        least = np.maximum(0.0, angle - spread - MARGIN)
        out[:, j] = np.where(outside, drift[j] * np.maximum(0.0, np.cos(least)), drift[j]) * (1 + MARGIN) + MARGIN
    np.fill_diagonal(out, 0)
    return out


def settle(x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: np.ndarray, exact: bool):
    """(cluster, upper, lower, distance, scanned) after one assignment to the
    centroids ``c``; ``distance`` is -1 where it was not needed and not ``exact``."""
    cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    distance = np.full(len(x), -1, np.int64)
    sure = upper * (1 + MARGIN) + MARGIN < lower
    own = np.flatnonzero(~sure & (cluster >= 0)) if not exact else np.flatnonzero(cluster >= 0)
    if len(own):
        step = x[own] - c[cluster[own]]
        distance[own] = (step * step).sum(axis=1)
        upper[own] = np.sqrt(distance[own].astype(np.float64)) * (1 + MARGIN)
        sure = (upper * (1 + MARGIN) + MARGIN < lower) & (cluster >= 0)
    scan = np.flatnonzero(~sure)
    if len(scan):
        d2 = squared(x[scan], c)
        k = np.argmin(d2, axis=1)  # the first of equals is the smallest number
        best = d2[np.arange(len(scan)), k]
        cluster[scan], distance[scan] = k, best
        upper[scan] = np.sqrt(best.astype(np.float64)) * (1 + MARGIN)
        if len(c) > 1:
            second = np.partition(d2, 1, axis=1)[:, 1]
            lower[scan] = np.sqrt(second.astype(np.float64)) * (1 - MARGIN)
        else:
            lower[scan] = np.inf
    return cluster, upper, lower, distance, ~sure


def assigned(state: DataFrame, c: np.ndarray, moved: tuple | None, cfg: ClusterConfig, exact: bool) -> DataFrame:
    """The next state. ``moved``: (drift of each centroid, loss of each
    cluster's lower bound), None before the first round."""
    width, most = cfg.components, largest_whole(cfg.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), cfg.rows_at_once):
                b = whole.slice(k, cfg.rows_at_once)
                x = whole_numbers(matrix(b.column(1), width), cfg.scale, most)
                if moved is None:
                    cluster = np.full(len(x), -1, np.int32)
                    upper, lower = np.full(len(x), np.inf), np.zeros(len(x))
                else:
                    cluster, upper, lower = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
                    upper, lower = upper + moved[0][cluster], lower - moved[1][cluster]
                out = settle(x, cluster, upper, lower, c, exact)
                cols = [pa.array(o.astype(t)) for o, t in zip(out, (np.int32, np.float64, np.float64, np.int64, np.bool_))]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=[f.split(" ")[0] for f in STATE.split(", ")])

    return state.mapInArrow(run, STATE)


def _gathered(state: DataFrame, k: int, cfg: ClusterConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, counts, radius of the sphere) of each cluster, over all vectors."""
    width, most = cfg.components, largest_whole(cfg.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n, reach = np.zeros((k, width), np.int64), np.zeros(k, np.int64), np.zeros(k)
        for b in batches:
            x = whole_numbers(matrix(b.column(0), width), cfg.scale, most)
            cluster = b.column(1).to_numpy(zero_copy_only=False)
            n += np.bincount(cluster, minlength=k)
            np.maximum.at(reach, cluster, b.column(2).to_numpy(zero_copy_only=False))
            for j in np.unique(cluster):
                sums[j] += x[cluster == j].sum(axis=0)
        row, pos = np.divmod(np.arange(sums.size), width)
        cols = [row.astype(np.int32), pos.astype(np.int32), sums.ravel(), n[row], reach[row]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["cluster", "pos", "s", "n", "r"])

    part = state.select("v", "cluster", "upper").mapInArrow(run, "cluster int, pos int, s long, n long, r double")
    total = part.groupBy("cluster", "pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("r").alias("r")).toPandas()
    sums, n, reach = np.zeros((k, width), np.int64), np.zeros(k, np.int64), np.zeros(k)
    sums[total.cluster, total.pos] = total.s
    n[total.cluster] = total.n
    reach[total.cluster] = total.r
    return sums, n, reach


def _move(old: np.ndarray, sums: np.ndarray, n: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The new centroids, and (drift, loss) for the next round's bounds."""
    new = np.where(n[:, None] > 0, sums // np.maximum(n, 1)[:, None], old)
    drift = np.sqrt(((new - old).astype(np.float64) ** 2).sum(axis=1)) * (1 + MARGIN)
    return new, (drift, losses(old, new, reach).max(axis=1))


def clusters(vectors: DataFrame, cfg: ClusterConfig = ClusterConfig(), id_col: str = "vec_id", vec_col: str = "embedding"
             ) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance, scanned), the final centroids). ``scanned``:
    whether the last assignment had to look at all centroids."""
    rows = vectors.where(finite(vec_col)).select(F.col(id_col).cast("long").alias("vec_id"), doubles(vec_col).alias("v"))
    rows = rows.where(F.size("v") == cfg.components)
    place = F.sha2(F.concat(F.lit(f"{cfg.seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(place.asc_nulls_last(), "v").limit(cfg.centroids).collect()
    x = np.array([r.v for r in first], np.float64).reshape(len(first), cfg.components)
    c = whole_numbers(x, cfg.scale, largest_whole(cfg.components))
    none = [F.lit(None).cast(t).alias(n) for n, t in (("cluster", "int"), ("upper", "double"), ("lower", "double"))]
    state, moved = rows.select("vec_id", "v", *none), None
    if not len(c):
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, scanned boolean"), c
    for _ in range(cfg.rounds):
        state = written(assigned(state.select("vec_id", "v", "cluster", "upper", "lower"), c, moved, cfg, False), "vec-state")
        c, moved = _move(c, *_gathered(state, len(c), cfg))
    last = assigned(state.select("vec_id", "v", "cluster", "upper", "lower"), c, moved, cfg, True)
    return last.select("vec_id", "cluster", "distance", "scanned"), c


def centroid_digest(row: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()


def cluster_table(vectors: DataFrame, cfg: ClusterConfig = ClusterConfig(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    found, c = clusters(vectors, cfg, id_col, vec_col)
    found = written(found, "vec-clusters")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row a centroid
    facts = [(k, s, sum(sums.values()), centroid_digest(c[k])) for k, s in sorted(sums.items())]
    table = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # at most cfg.centroids rows
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
