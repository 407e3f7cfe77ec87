"""Vector similarity joins on unit vectors (cosine = dot product).

Both joins are exact and prune by angles, which form a metric: a vector lies
within ``radius`` of its cell's pivot, so no two vectors of cells A and B are
closer than angle(A, B) - radius(A) - radius(B).

``similar_pairs`` deals the vectors into cells of about ``block_rows``, level by
level: a cell above that gets pivots of its own, and its vectors go to the
nearest of them. Pairs of cells that can hold a pair above the threshold are
found down the same levels, so pairs of cells that are far apart are left out
with all their children. What remains are products of two blocks, one pair of
blocks a task, and only pairs above the threshold leave it.

``nearest_neighbours`` streams the left side past the right side where that is
one block (the usual registry): no exchange at all. A larger right side is dealt
into cells around pivots. Each left vector searches the cell of its nearest
pivot, and then only those cells that may hold something better.

Cells, blocks and their meetings are DataFrames. The driver holds the pivots of
a level (PIVOT_BYTES at most) and one number per cell.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantage.constants import MAX_CANDIDATES
from vantage.operators.util import broadcast_if_small
from vantage.session import scratch_path

DEFAULT_BLOCK_ROWS = 4096
PIVOT_BYTES = 64 << 20  # of all pivots, or of a right side, that tasks hold
PIVOTS = 64  # of a cell; below 2: no cells, every block meets every block
SLACK = 1e-6  # of an angle: arccos loses half the digits near 1

PAIR_SCHEMA = "id_a long, id_b long, similarity double"
NEIGHBOUR_SCHEMA = "left_id long, right_id long, similarity double"


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", m, m))
    if np.any(norms <= 0):
        raise ValueError("a vector without length has no direction")
    return m / norms[:, None]


def _unit_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The rows of a list column as unit vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return _unit(flat.reshape(len(column), -1))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _vector_type(df: DataFrame) -> str:
    return df.schema["v"].dataType.simpleString()


def _angles(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(m @ pivots.T, -1.0, 1.0))


# --- all pairs above a threshold ---------------------------------------------


class PairSearch(NamedTuple):
    pairs: DataFrame  # id_a, id_b, similarity
    routes: DataFrame | None  # (cg, ch, n, m): pairs of blocks compared, with their sizes; None: one block

    def compared(self, rows: int) -> int:
        """Pairs of vectors that were multiplied, of rows * (rows - 1) / 2."""
        if self.routes is None:
            return rows * (rows - 1) // 2
        own = F.col("n") * (F.col("n") - 1) / 2
        n = F.sum(F.when(F.col("cg") == F.col("ch"), own).otherwise(F.col("n") * F.col("m")))
        return int(self.routes.agg(n.alias("n")).first()["n"] or 0)


def similar_pairs(vectors: DataFrame, threshold: float, id_col: str = "viewpoint_id",
                  vec_col: str = "centroid", block_rows: int = DEFAULT_BLOCK_ROWS,
                  pivots: int = PIVOTS, seed: int = 42) -> DataFrame:
    """All pairs a < b with cosine(a, b) >= threshold: (id_a, id_b, similarity)."""
    return search_pairs(vectors, threshold, id_col, vec_col, block_rows, pivots, seed).pairs


def search_pairs(vectors: DataFrame, threshold: float, id_col: str = "viewpoint_id", vec_col: str = "centroid",
                 block_rows: int = DEFAULT_BLOCK_ROWS, pivots: int = PIVOTS, seed: int = 42) -> PairSearch:
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    if v.select("id").limit(block_rows + 1).count() <= block_rows:
        return PairSearch(v.coalesce(1).mapInArrow(_one_block(threshold), PAIR_SCHEMA), None)
    celled, levels = recursive_cells(v, block_rows, pivots, seed)
    blocked, routes = block_routes(celled, levels, threshold, block_rows)
    ends = F.explode(F.array_distinct(F.array("cg", "ch"))).alias("blk")
    sent = blocked.select("id", "v", "blk").join(routes.select(ends, "cg", "ch"), "blk")
    return PairSearch(sent.groupBy("cg", "ch").applyInArrow(_block_product(threshold), PAIR_SCHEMA), routes)


def _pairs_between(ids: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> list[pa.Array]:
    """id_a, id_b, similarity of the pairs at or above the threshold between
    the rows ``a`` and ``b`` of ``m``; each pair once where both are the same.
    Rows too far from all of the other side leave before the product."""
    if a is not b:
        a, b = a[_can_meet(m[a], m[b], threshold)], b[_can_meet(m[b], m[a], threshold)]
    found = []
    for k in range(0, len(a), 1024):  # strips of the product
        s = m[a[k : k + 1024]] @ m[b].T
        if a is b:
            s[np.tril_indices(len(s), k, s.shape[1])] = -2.0
        i, j = np.nonzero(s >= threshold)
        found.append((ids[a[k : k + 1024]][i], ids[b][j], s[i, j]))
    x, y, s = (np.concatenate([f[c] for f in found]) if found else np.zeros(0) for c in range(3))
    return [pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64()), pa.array(s, pa.float64())]


def _can_meet(m: np.ndarray, other: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``m`` lie within arccos(threshold) of the sphere around
    the other rows' mean direction."""
    centre = other.sum(axis=0)
    length = float(np.sqrt(centre @ centre))
    if length < 1e-6 * len(other):  # no direction
        return np.ones(len(m), bool)
    centre = (centre / length)[None, :]
    reach = _angles(other, centre).max() + np.arccos(np.clip(threshold, -1.0, 1.0)) + SLACK
    return _angles(m, centre)[:, 0] <= reach


def _block_product(threshold: float):
    """Task body for one pair of blocks ``cg`` and ``ch`` (one when equal)."""

    def product(t: pa.Table) -> pa.Table:
        blk = t["blk"].to_numpy()
        cg, ch = t["cg"][0].as_py(), t["ch"][0].as_py()
        a = np.flatnonzero(blk == cg)
        b = a if cg == ch else np.flatnonzero(blk == ch)
        return pa.table(_pairs_between(t["id"].to_numpy(), _unit_matrix(t["v"]), a, b, threshold), names=["id_a", "id_b", "similarity"])

    return product


def _one_block(threshold: float):
    """Task body for a table of one block, in one task."""

    def product(batches):
        t = [b for b in batches if len(b)]
        if t:
            ids = np.concatenate([b.column(0).to_numpy() for b in t])
            m = np.concatenate([_unit_matrix(b.column(1)) for b in t])
            every = np.arange(len(ids))
            yield pa.RecordBatch.from_arrays(_pairs_between(ids, m, every, every, threshold), names=["id_a", "id_b", "similarity"])

    return product


def recursive_cells(v: DataFrame, block_rows: int, fan: int, seed: int) -> tuple[DataFrame, list[DataFrame]]:
    """((id, v, cell), levels). Each level is a table (parent, cell, pivot,
    radius, n): the cells of that level, with those of the level before that
    were not split as their own children."""
    spark = v.sparkSession
    celled = _kept(v.select("id", "v", F.lit(0).cast("long").alias("cell")), "cells")
    width = max(1, celled.agg(F.max(F.size("v"))).first()[0] or 1)
    levels, done, following = [], {}, 1  # done: cells that are not split any more
    if fan < 2:
        return celled, levels
    while True:
        large = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows)
        budget = max(1, PIVOT_BYTES // (8 * width * fan))
        # at most budget rows: as many cells as their pivots fit
        todo = {r["cell"]: r["n"] for r in large.where(~F.col("cell").isin(list(done) or [-1])).orderBy(F.col("n").desc(), "cell").limit(budget).collect()}
        if not todo:
            return celled, levels
        mine = celled.where(F.col("cell").isin(list(todo)))
        mark = F.xxhash64("id", F.lit(seed + len(levels)))
        chosen = mine.groupBy("cell", F.pmod(mark, F.lit(fan)).alias("f")).agg(F.min_by("v", F.struct(mark, "id")).alias("p"))
        pivots: dict[int, tuple[int, np.ndarray]] = {}
        for cell, rows in _grouped(chosen.orderBy("cell", "f").collect(), "cell"):
            pivots[cell] = (following, _unit(np.array([r["p"] for r in rows], np.float64)))
            following += len(rows)

        def deal(batches, pivots=pivots):
            for b in batches:
                cell = b.column(2).to_numpy(zero_copy_only=False).copy()
                angle = np.full(len(cell), np.nan)
                for c in np.unique(cell):
                    if int(c) in pivots:
                        at = np.flatnonzero(cell == c)
                        base, piv = pivots[int(c)]
                        ang = _angles(_unit_matrix(b.column(1).take(pa.array(at))), piv)
                        near = ang.argmin(axis=1)
                        cell[at], angle[at] = base + near, ang[np.arange(len(at)), near]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell), pa.array(angle)], names=["id", "v", "cell", "angle"])

        dealt = _kept(celled.select("id", "v", "cell").mapInArrow(deal, f"id long, v {_vector_type(celled)}, cell long, angle double"), "cells")
        made = {r["cell"]: r for r in dealt.where("not isnan(angle)").groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect()}  # fan rows a split cell
        rows = []
        for parent, (base, piv) in pivots.items():
            for k, p in enumerate(piv):
                if base + k in made:
                    r = made[base + k]
                    rows.append((parent, base + k, p.tolist(), float(r["radius"]), int(r["n"])))
                    if r["n"] == todo[parent]:  # all vectors alike: no use in going on
                        done[base + k] = True
        new = spark.createDataFrame(rows, "parent long, cell long, pivot array<double>, radius double, n long")
        if levels:
            same = levels[-1].where(~F.col("cell").isin(list(todo))).select(F.col("cell").alias("parent"), "cell", "pivot", "radius", "n")
            new = new.unionByName(same)
        levels.append(_kept(new, "cell-level"))
        celled = dealt.select("id", "v", "cell")


def _grouped(rows: list, key: str):
    from itertools import groupby

    return [(k, list(g)) for k, g in groupby(rows, key=lambda r: r[key])]


def block_routes(celled: DataFrame, levels: list[DataFrame], threshold: float, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """((id, v, blk), (cg, ch, n, m)): the vectors with their block, and the
    pairs of blocks (cg <= ch) to compare with their numbers of vectors."""
    reach = float(np.arccos(np.clip(threshold, -1.0, 1.0))) + SLACK
    spark = celled.sparkSession
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    dot = F.aggregate(F.zip_with("pa", "pb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    for level in levels:
        side = lambda k: level.select(F.col("parent").alias(f"u{k}"), F.col("cell").alias(f"c{k}"), F.col("pivot").alias(f"p{k}"), F.col("radius").alias(f"r{k}"))
        met = pairs.join(side("a"), F.col("a") == F.col("ua")).join(side("b"), F.col("b") == F.col("ub"))
        met = met.where((F.col("a") < F.col("b")) | (F.col("ca") <= F.col("cb")))
        met = met.where((F.col("ca") == F.col("cb")) | (apart - F.col("ra") - F.col("rb") <= reach))
        pairs = _kept(met.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "cell-pairs")
    # A cell that could not be split takes several blocks, by hash.
    sizes = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).withColumn("parts", F.ceil(F.col("rows") / block_rows).cast("int"))
    blocked = celled.join(broadcast_if_small(sizes.select("cell", "parts")), "cell")
    blk = F.shiftleft(F.col("cell"), 20) + F.pmod(F.xxhash64("id"), F.col("parts"))
    blocked = _kept(blocked.select("id", "v", "cell", blk.alias("blk")), "cell-blocks")
    counts = blocked.groupBy("cell", "blk").agg(F.count(F.lit(1)).alias("n"))
    left = counts.select(F.col("cell").alias("a"), F.col("blk").alias("cg"), "n")
    right = counts.select(F.col("cell").alias("b"), F.col("blk").alias("ch"), F.col("n").alias("m"))
    routes = pairs.join(left, "a").join(right, "b").where((F.col("a") < F.col("b")) | (F.col("cg") <= F.col("ch")))
    return blocked, _kept(routes.select("cg", "ch", "n", "m"), "cell-routes")


# --- nearest neighbours --------------------------------------------------------


def _best(rows: np.ndarray, ml: np.ndarray, right_ids: np.ndarray, mr: np.ndarray, k: int, threshold: float | None):
    """(row, right id, similarity, rank) of the k best right rows of each left
    row; right rows come in id order, so that among equal scores the lower id
    is first."""
    s = ml @ mr.T
    kk = min(k, s.shape[1])
    order = np.argmax(s, axis=1)[:, None] if kk == 1 else np.argsort(-s, axis=1, kind="stable")[:, :kk]
    which = np.repeat(np.arange(s.shape[0]), kk)
    cols = order.ravel()
    sims = s[which, cols]
    rank = np.tile(np.arange(1, kk + 1), s.shape[0])
    keep = sims >= threshold if threshold is not None else np.ones_like(sims, dtype=bool)
    return rows[which][keep], right_ids[cols][keep], sims[keep], rank[keep]


def nearest_neighbours(left: DataFrame, right: DataFrame, k: int = 1, threshold: float | None = None,
                       left_id: str = "seq", left_vec: str = "embedding",
                       right_id: str = "viewpoint_id", right_vec: str = "centroid",
                       block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """For each left row the k most similar right vectors (ties: lower right
    id), optionally only those >= threshold, with their rank (1 = best):
    (left_id, right_id, similarity, rank). Rows that repeat a left id are
    answered one by one; left rows without a candidate are absent."""
    lv = left.select(F.col(left_id).cast("long").alias("id"), F.col(left_vec).alias("v"))
    rv = right.select(F.col(right_id).cast("long").alias("id"), F.col(right_vec).alias("v"))
    # one block at most, kept: a costly right side runs once where it is small
    head = _kept(rv.limit(block_rows + 1), "nn-head")
    size = head.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    if not size["n"]:
        return left.sparkSession.createDataFrame([], NEIGHBOUR_SCHEMA + ", rank int")
    if size["n"] <= min(block_rows, PIVOT_BYTES // (8 * max(1, size["d"]))):
        return _past_one_block(lv, head, k, threshold)
    size = rv.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    return _by_cells(lv, rv, size["n"], size["d"], k, threshold, block_rows)


def _past_one_block(lv: DataFrame, rv: DataFrame, k: int, threshold: float | None) -> DataFrame:
    head = sorted(rv.collect(), key=lambda r: r["id"])  # checked: one block, PIVOT_BYTES at most
    ids = np.array([r["id"] for r in head], np.int64)
    matrix = _unit(np.array([r["v"] for r in head], np.float64))

    def stream(batches):
        for b in batches:
            if len(b):
                rows, found, sims, rank = _best(np.arange(len(b)), _unit_matrix(b.column(1)), ids, matrix, k, threshold)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), pa.array(found), pa.array(sims), pa.array(rank.astype(np.int32))],
                    names=["left_id", "right_id", "similarity", "rank"])

    return lv.mapInArrow(stream, NEIGHBOUR_SCHEMA + ", rank int")


def _by_cells(lv: DataFrame, rv: DataFrame, n: int, d: int, k: int, threshold: float | None, block_rows: int) -> DataFrame:
    most = max(2, min(1024, PIVOT_BYTES // (8 * max(1, d))))
    wanted = max(2, min(most, 4 * math.ceil(n / block_rows)))
    chosen = rv.orderBy(F.xxhash64("id", F.lit(42)), "id").limit(wanted).collect()
    pivots = _unit(np.array([r["v"] for r in chosen], np.float64))

    def home(batches):
        for b in batches:
            ang = _angles(_unit_matrix(b.column(1)), pivots) if len(b) else np.zeros((0, 1))
            cell = ang.argmin(axis=1) if len(b) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(cell.astype(np.int32)), pa.array(ang[np.arange(len(b)), cell])], names=[*b.schema.names, "cell", "angle"])

    rcell = _kept(rv.mapInArrow(home, f"id long, v {_vector_type(rv)}, cell int, angle double"), "nn-right")
    stats = {r["cell"]: r for r in rcell.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r")).collect()}  # a row a pivot
    used = np.array(sorted(stats))  # a pivot's copy may have taken all its vectors
    radius = np.array([stats[c]["r"] for c in used.tolist()])

    def nearest_used(batches):
        for b in batches:
            near = _angles(_unit_matrix(b.column(1)), pivots[used]).argmin(axis=1) if len(b) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(used[near].astype(np.int32))], names=[*b.schema.names, "cell"])

    # a row number, so that repeated ids stay apart; fixed once written
    rows = lv.mapInArrow(nearest_used, f"id long, v {_vector_type(lv)}, cell int").withColumn("row", F.monotonically_increasing_id())
    rows = _kept(rows, "nn-left")
    first = _kept(_searched(rows.select("row", "v", "cell"), rcell, stats, d, k, block_rows), "nn-first")
    worst = first.groupBy("row").agg(F.count(F.lit(1)).alias("n"), F.slice(F.sort_array(F.collect_list("similarity"), False), k, 1).alias("s"))
    worst = worst.select("row", F.when(F.col("n") >= k, F.get("s", F.lit(0))).alias("kth"))
    limit = math.pi if threshold is None else float(np.arccos(np.clip(threshold, -1.0, 1.0)))

    def others(batches):
        for b in batches:
            if not len(b):
                continue
            kth = np.nan_to_num(b.column(3).to_numpy(zero_copy_only=False).astype(np.float64), nan=-1.0)
            reach = np.minimum(np.arccos(np.clip(kth, -1.0, 1.0)), limit) + SLACK
            ang = _angles(_unit_matrix(b.column(1)), pivots[used])
            may = ang - radius <= reach[:, None]
            may &= used[None, :] != b.column(2).to_numpy(zero_copy_only=False)[:, None]
            i, c = np.nonzero(may)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(i)), pa.array(used[c].astype(np.int32))], names=["row", "cell"])

    open_ = rows.select("row", "v", "cell").join(worst, "row", "left").select("row", "v", "cell", "kth")
    more = _kept(open_.mapInArrow(others, "row long, cell int"), "nn-more")
    second = _searched(more.join(rows.select("row", "v"), "row").select("row", "v", "cell"), rcell, stats, d, k, block_rows)
    found = first.unionByName(second)
    if threshold is not None:
        found = found.where(F.col("similarity") >= threshold)
    if k == 1:
        top = F.max(F.struct("similarity", (-F.col("right_id")).alias("down"))).alias("m")  # combined before the shuffle
        best = found.groupBy("row").agg(top).select("row", (-F.col("m.down")).alias("right_id"), "m.similarity", F.lit(1).alias("rank"))
    else:
        # k rows a searched block at most
        w = Window.partitionBy("row").orderBy(F.col("similarity").desc(), F.col("right_id").asc())
        best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return rows.select("row", F.col("id").alias("left_id")).join(best, "row").select("left_id", "right_id", "similarity", "rank")


def _searched(rows: DataFrame, rcell: DataFrame, stats: dict, d: int, k: int, block_rows: int) -> DataFrame:
    """(row, right_id, similarity): the k best of each row (row, v, cell) in
    its cell. Large cells are cut into blocks by hash, and a cell's rows into
    chunks, so a hot cell spreads over many tasks."""
    spark = rows.sparkSession
    chunk = max(1, min(16 * block_rows, PIVOT_BYTES // (8 * max(1, d))))
    lefts = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a pivot
    plan = [(c, math.ceil(stats[c]["n"] / block_rows), math.ceil(n / chunk)) for c, n in sorted(lefts.items())]
    parts = F.broadcast(spark.createDataFrame(plan, "cell int, blocks int, chunks int"))  # 1,024 rows at most
    lrep = rows.join(parts, "cell").select(
        "row", "v", "cell", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    rrep = rcell.join(parts, "cell").select(
        "id", "v", "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))

    def search(lt: pa.Table, rt: pa.Table) -> pa.Table:
        parts: list = [[], [], []]
        if lt.num_rows and rt.num_rows:
            rt = rt.sort_by("id")
            mr, ids = _unit_matrix(rt["v"]), rt["id"].to_numpy()
            ml, at = _unit_matrix(lt["v"]), lt["row"].to_numpy()
            for j in range(0, len(ml), 1024):  # strips of the product
                for part, x in zip(parts, _best(at[j : j + 1024], ml[j : j + 1024], ids, mr, k, None)):
                    part.append(x)
        row, right, sims = (np.concatenate(p) if p else np.zeros(0) for p in parts)
        return pa.table({"row": pa.array(row, pa.int64()), "right_id": pa.array(right, pa.int64()), "similarity": pa.array(sims, pa.float64())})

    keys = ("cell", "chunk", "block")
    return lrep.groupBy(*keys).cogroup(rrep.groupBy(*keys)).applyInArrow(search, "row long, right_id long, similarity double")


def nearest_centroid(embeddings: DataFrame, registry: DataFrame, threshold: float | None = None,
                     block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Each embedding's most similar centroid (ties: lowest id):
    (seq, viewpoint_id, similarity); with a threshold, rows below it get a
    null viewpoint."""
    best = nearest_neighbours(embeddings, registry, k=1, block_rows=block_rows).select(
        F.col("left_id").alias("seq"), F.col("right_id").alias("viewpoint_id"), "similarity"
    )
    if threshold is None:
        return best
    return best.select(
        "seq",
        F.when(F.col("similarity") >= threshold, F.col("viewpoint_id")).alias("viewpoint_id"),
        "similarity",
    )


def top_candidate_pairs(pairs: DataFrame, max_candidates: int = MAX_CANDIDATES) -> DataFrame:
    """Strongest pairs first (ties by ids), at most ``max_candidates``."""
    return pairs.orderBy(F.col("similarity").desc(), "id_a", "id_b").limit(int(max_candidates))


def unit_vectors(df: DataFrame, vec_col: str, out: str | None = None) -> DataFrame:
    from vantage.functions import l2_normalize

    return df.withColumn(out or vec_col, l2_normalize(vec_col))


def label_cosine(embeddings: DataFrame, centroids: DataFrame) -> DataFrame:
    """Cosine of each embedding with its label's centroid (built-in expressions)."""
    from vantage.functions import cosine_of_units, l2_normalize

    e = embeddings.select("seq", "label", l2_normalize("embedding").alias("u"))
    c = centroids.select(F.col("viewpoint_id").alias("label"), l2_normalize("centroid").alias("c"))
    return e.join(broadcast_if_small(c), "label").select(
        "seq", "label", cosine_of_units("u", "c").alias("cosine")
    )
