"""Product codes of vectors, nearest entries found with a GNAT.

A vector's components become whole numbers, floor(scale * x), and the vector is
cut into equal consecutive parts. Every part position has a codebook; a part's
code is its nearest entry by squared Euclidean distance, ties to the lower
index. Training repeats exact whole-number rounds: assign every part of every
vector, replace each entry by floor(sum / count) of its parts.

The nearest entry is searched in a geometric near-neighbour access tree over
the codebook (at most 256 entries a position). A node holds split points, and
for each split point and each child the least and greatest distance from the
split point to the child's entries. A query measures its distances to the split
points; a child goes out, with all below it, only where some split point proves
that every entry of the child is strictly farther than the best one so far.
These proofs use square roots with a margin on the safe side; who wins is
decided by whole-number squared distances and indices, so ties are exact.

Each round reads the table once; a task passes on one sum per (position, entry,
component), so nothing is shuffled but parts * entries * width rows a task, and
the driver holds the codebooks only.

Defined results: vectors that are null or hold null or non-finite components
are left out, as are empty ones and those whose length cannot be cut into equal
parts or differs from that of the kept vector with the smallest id; fewer kept
vectors than entries give that many entries; null ids come last in the choice
of entries; repeated rows each count and get a row; null labels stand together;
an empty table gives an empty result; a component too large for exact squared
distances in 64 bits is an error; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.shared import join_split, written
from vantage.llm.vectors import doubles, finite, largest_whole, matrix, whole_numbers

MARGIN = 1e-9  # of a distance, relative and absolute


@dataclass(frozen=True)
class CodeConfig:
    parts: int = 16
    entries: int = 64  # at most 256: a code has two hex digits a part
    rounds: int = 2
    scale: int = 256
    degree: int = 8  # split points of a GNAT node
    rows_at_once: int = 4096


# --- the tree -----------------------------------------------------------------


@dataclass
class Node:
    """``at``: entry numbers of the split points (ascending), ``points``: their
    values; child j holds the entries nearest to split point j, and lies within
    low[i, j] .. high[i, j] of split point i."""

    at: np.ndarray
    points: np.ndarray
    children: list = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        step = a[:, k, None] - b[None, :, k]
        out += step * step
    return out


def grow(points: np.ndarray, at: np.ndarray, degree: int) -> Node:
    """A node over the entries numbered ``at``. Split points are chosen far
    from each other: first the lowest entry, then the one farthest from all."""
    if len(at) <= degree:
        return Node(at, points[at])
    every = squared(points[at], points[at])
    chosen = [0]
    away = every[0].copy()
    while len(chosen) < degree:
        k = int(np.argmax(away))
        if away[k] == 0:  # the rest equals a split point
            break
        chosen.append(k)
        away = np.minimum(away, every[k])
    chosen = np.sort(chosen)
    rest = np.setdiff1d(np.arange(len(at)), chosen)
    home = np.argmin(every[rest][:, chosen], axis=1)
    node = Node(at[chosen], points[at[chosen]], [None] * len(chosen))
    node.low = np.full((len(chosen),) * 2, np.inf)
    node.high = np.full((len(chosen),) * 2, -np.inf)
    for j in range(len(chosen)):
        mine = rest[home == j]
        if len(mine):
            dist = np.sqrt(every[chosen][:, mine].astype(np.float64))
            node.low[:, j], node.high[:, j] = dist.min(axis=1), dist.max(axis=1)
            if len(mine) == len(at) - 1:  # one split point only: no further cut
                node.children[j] = Node(at[mine], points[at[mine]])
            else:
                node.children[j] = grow(points, at[mine], degree)
    return node


def search(node: Node, q: np.ndarray, rows: np.ndarray, best: np.ndarray, who: np.ndarray) -> None:
    """Improves (best squared distance, entry) of the queries ``rows``."""
    d2 = squared(q[rows], node.points)
    k = np.argmin(d2, axis=1)  # the first of equals has the lowest number
    near, number = d2[np.arange(len(rows)), k], node.at[k]
    wins = (near < best[rows]) | ((near == best[rows]) & (number < who[rows]))
    best[rows[wins]], who[rows[wins]] = near[wins], number[wins]
    if not node.children:
        return
    dist = np.sqrt(d2.astype(np.float64))
    for j, child in enumerate(node.children):
        if child is None:
            continue
        r = np.sqrt(best[rows].astype(np.float64)) * (1 + MARGIN) + MARGIN
        slack = MARGIN * (1 + dist)
        beyond = (dist - slack - r[:, None] > node.high[:, j] * (1 + MARGIN)) | (dist + slack + r[:, None] < node.low[:, j] * (1 - MARGIN))
        alive = ~beyond.any(axis=1)
        if alive.any():
            search(child, q, rows[alive], best, who)


def nearest(tree: Node, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each query, ties to the lower entry."""
    best = np.full(len(q), np.iinfo(np.int64).max)
    who = np.full(len(q), np.iinfo(np.int64).max)
    if len(q):
        search(tree, q, np.arange(len(q)), best, who)
    return who, best


def trees(books: np.ndarray, degree: int) -> list[Node]:
    return [grow(book, np.arange(len(book)), degree) for book in books]


def assign(x: np.ndarray, grown: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """(entries, squared distances), a column for each part."""
    width = x.shape[1] // len(grown)
    found = [nearest(t, x[:, p * width : (p + 1) * width]) for p, t in enumerate(grown)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


# --- training and coding ------------------------------------------------------


def _blocks(column: pa.Array, width: int, cfg: CodeConfig) -> Iterator[tuple[slice, np.ndarray]]:
    most = largest_whole(width)
    for k in range(0, len(column), cfg.rows_at_once):
        part = column.slice(k, cfg.rows_at_once)
        yield slice(k, k + len(part)), whole_numbers(matrix(part, width), cfg.scale, most)


def kept_rows(vectors: DataFrame, cfg: CodeConfig, id_col: str, vec_col: str, *more: Column) -> tuple[DataFrame, list]:
    """(vec_id, v, more...) of the vectors that are coded, and the first
    ``entries`` of them by id."""
    rows = vectors.where(finite(vec_col)).select(F.col(id_col).cast("long").alias("vec_id"), doubles(vec_col).alias("v"), *more)
    rows = rows.where((F.size("v") > 0) & (F.size("v") % cfg.parts == 0))
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = rows.select("vec_id", "v").orderBy(*by_id).limit(cfg.entries).collect()
    if len({len(r.v) for r in first}) > 1:
        rows = rows.where(F.size("v") == len(first[0].v))
        first = rows.select("vec_id", "v").orderBy(*by_id).limit(cfg.entries).collect()
    return rows, first


def train(rows: DataFrame, first: list, cfg: CodeConfig) -> np.ndarray:
    """The final codebooks: (parts, entries, width of a part)."""
    width = len(first[0].v)
    x = whole_numbers(np.array([r.v for r in first], np.float64), cfg.scale, largest_whole(width))
    books = np.ascontiguousarray(x.reshape(len(x), cfg.parts, -1).transpose(1, 0, 2))
    for _ in range(cfg.rounds):
        books = _round(rows, books, cfg)
    return books


def _round(rows: DataFrame, books: np.ndarray, cfg: CodeConfig) -> np.ndarray:
    parts, entries, w = books.shape
    width = parts * w

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = trees(books, cfg.degree)
        sums, n = np.zeros((parts * entries, w), np.int64), np.zeros(parts * entries, np.int64)
        for b in batches:
            for _, x in _blocks(b.column(0), width, cfg):
                cell = (assign(x, grown)[0] + np.arange(parts) * entries).ravel()
                np.add.at(sums, cell, x.reshape(-1, w))
                n += np.bincount(cell, minlength=len(n))
        cell, pos = np.divmod(np.arange(sums.size), w)
        used = n[cell] > 0
        cols = [cell[used].astype(np.int32), pos[used].astype(np.int32), sums.ravel()[used], n[cell][used]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["cell", "pos", "s", "n"])

    part = rows.select("v").mapInArrow(run, "cell int, pos int, s long, n long")
    total = part.groupBy("cell", "pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).toPandas()  # a row a component
    out = books.reshape(parts * entries, w).copy()
    out[total.cell, total.pos] = total.s.to_numpy(np.int64) // total.n.to_numpy(np.int64)
    return out.reshape(books.shape)


def encode(rows: DataFrame, books: np.ndarray, cfg: CodeConfig) -> DataFrame:
    """vec_id, code, error and the further columns of ``rows`` but v."""
    parts, _, w = books.shape
    others = [f for f in rows.schema.fields if f.name != "v"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others) + ", code string, error long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown = trees(books, cfg.degree)
        for b in batches:
            codes: list[str] = []
            error = np.zeros(len(b), np.int64)
            for at, x in _blocks(b.column(len(others)), parts * w, cfg):
                entry, d2 = assign(x, grown)
                digits = entry.astype(np.uint8).tobytes().hex()
                codes += [digits[k : k + 2 * parts] for k in range(0, len(digits), 2 * parts)]
                error[at] = d2.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(others)], pa.array(codes, pa.string()), pa.array(error)], names=[*[f.name for f in others], "code", "error"])

    return rows.select(*[f.name for f in others], "v").mapInArrow(run, schema)


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, cfg: CodeConfig = CodeConfig(), id_col: str = "vec_id", vec_col: str = "embedding",
             label_col: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: one row a coded vector."""
    # a null label is a key of its own, unlike any text
    label = F.coalesce(F.concat(F.lit("="), F.col(label_col).cast("string")), F.lit("null")).alias("kind")
    rows, first = kept_rows(vectors, cfg, id_col, vec_col, label)
    if not first:
        schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)
    books = train(rows, first, cfg)
    coded = written(encode(rows, books, cfg), "vec-codes")
    kinds = coded.groupBy("kind").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("size"))
    out = join_split(coded, kinds, "kind", "size", max(1, coded.count()))
    return out.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))
