"""Near-duplicate vectors by PCA-ordered tiled comparison.

Two vectors link when their cosine is at least ``threshold``; vectors
reachable over links form a component.

1. Every usable vector is scaled to length 1. Equal unit vectors (by SHA-256 of
   their doubles) become one class with its number of copies, so a vector that
   a third of all rows share is compared once.
2. The second moments of all classes give the principal directions; a rotation
   keeps every product, and puts most of a vector's length into its leading
   components.
3. A tree of median cuts over the leading components (placed on a bounded
   sample; any cuts give the same result) deals the classes into tiles of about
   ``block_rows``. Every class is in one tile, and a tile's box, centre and
   radius are taken over all its members.
4. Pairs of tiles whose boxes or spheres are too far apart are left out; pairs
   whose spheres lie so close that every member must link are counted without
   a comparison; the rest are compared, one pair of tiles a task. Pairs of
   vectors start with ``lead`` leading components: product so far plus the
   product of the two suffix norms bounds the cosine from above, and a pair
   ends where that bound is below the threshold. Survivors get the next
   components, twice as many each time, until the cosine is whole.
5. A task passes on each vector's number of links and one edge to the root of
   its linked set, never all pairs; components.py joins these.

Bounds carry a margin for rounding, and a cosine within 1e-9 of the threshold
is taken again from the vectors before the rotation.

Cost: pairs of tiles that neither bound decides are quadratic, at ``lead``
multiplications a pair of vectors; nothing else grows faster than the input.

Defined results: a vector that is null, zero, empty, or holds null or
non-finite components links with nothing and is its own component; vectors of
different lengths never link; repeated rows each count and get a row; a null id
is never the smallest of a component that holds another id, and a component of
null ids only has a null id and is kept; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.components import connected_components
from vantage.llm.shared import join_split, written
from vantage.llm.vectors import doubles, finite, matrix

ROUNDING = 1e-9


@dataclass(frozen=True)
class EmbeddingDedupConfig:
    threshold: float = 0.95
    lead: int = 16  # components of the first bound; the next steps take twice as many
    # Vectors of a tile, fewer where a tile would be larger than block_bytes.
    block_rows: int = 8192
    block_bytes: int = 32 << 20
    max_leaves: int = 1024  # leaves of the tree; a larger leaf is dealt into several tiles by hash
    # The cuts are placed on about this many vectors; no result depends on them.
    sample_rows: int = 65_536
    box_dims: int = 16
    strip: int = 1024  # rows and columns of one matrix product
    # Components that are rotated (the driver holds a table of that many squared)
    # and lengths of vectors that get a rotation, the most frequent first.
    pca_dims: int = 512
    pca_lengths: int = 8


# --- unit vectors and classes -------------------------------------------------


def unit_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, key, dim, unit): the unit vector as packed doubles and the
    SHA-256 of these; null where the vector cannot link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys: list = [None] * len(b)
            units: list = [None] * len(b)
            sizes = np.nan_to_num(pc.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)).astype(np.int64)
            for d in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == d)
                x = matrix(b.column(1).take(pa.array(at)), int(d))
                most = np.abs(x).max(axis=1)
                at, x, most = at[most > 0], x[most > 0], most[most > 0]
                x = x / most[:, None]  # no square overflows or vanishes
                x = x / np.sqrt((x * x).sum(axis=1))[:, None] + 0.0  # -0.0 becomes 0.0
                for k, row in zip(at.tolist(), x):
                    units[k] = row.tobytes()
                    keys[k] = hashlib.sha256(units[k]).digest()
            dims = pa.array(sizes.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(keys, pa.binary()), dims, pa.array(units, pa.binary())], names=["vec_id", "key", "dim", "unit"]
            )

    usable = F.when(finite(vec_col), doubles(vec_col))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), usable.alias("v"))
    return rows.mapInArrow(run, "vec_id long, key binary, dim int, unit binary")


def _packed(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, d)


def _by_length(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, unit vectors) of a batch with columns dim, unit."""
    dims = b.column(b.schema.get_field_index("dim")).to_numpy(zero_copy_only=False)
    units = b.column(b.schema.get_field_index("unit"))
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield int(d), at, _packed(units.take(pa.array(at)), int(d))


# --- rotation -----------------------------------------------------------------


def rotations(classes: DataFrame, lengths: list[int], cfg: EmbeddingDedupConfig) -> dict[int, np.ndarray]:
    """For each length the principal directions, strongest first, as columns."""
    chosen = set(lengths[: cfg.pca_lengths])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in _by_length(b):
                if d in chosen:
                    x = x[:, : cfg.pca_dims]
                    sums[d] = sums.get(d, 0) + x.T @ x
        for d, s in sums.items():
            i, j = np.divmod(np.arange(s.size), len(s))
            cols = [pa.array(np.full(s.size, d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(s.ravel())]
            yield pa.RecordBatch.from_arrays(cols, names=["dim", "i", "j", "s"])

    parts = classes.select("dim", "unit").mapInArrow(run, "dim int, i int, j int, s double")
    sums = parts.groupBy("dim", "i", "j").agg(F.sum("s").alias("s"))
    out = {}
    for d, s in sums.toPandas().groupby("dim"):  # at most pca_lengths * pca_dims**2 rows
        m = np.zeros((min(d, cfg.pca_dims),) * 2)
        m[s.i, s.j] = s.s
        out[int(d)] = np.ascontiguousarray(np.linalg.eigh((m + m.T) / 2)[1][:, ::-1])
    return out


def rotated(x: np.ndarray, rotation: np.ndarray | None) -> np.ndarray:
    if rotation is None:
        return x
    k = len(rotation)
    return np.concatenate([x[:, :k] @ rotation, x[:, k:]], axis=1)


# --- tiles --------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Median cuts of one length's leading components. Node 0 is the root;
    ``axis`` -1 marks a leaf, whose number is in ``left``."""

    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaf(self, y: np.ndarray) -> np.ndarray:
        node = np.zeros(len(y), np.int64)
        while True:
            axis = self.axis[node]
            open_ = axis >= 0
            if not open_.any():
                return self.left[node]
            go = y[open_, axis[open_]] < self.cut[node[open_]]
            node[open_] = np.where(go, self.left[node[open_]], self.right[node[open_]])


def grow(y: np.ndarray, leaves: int, first: int) -> tuple[Tree, int]:
    """A tree of at most ``leaves`` leaves over sampled coordinates, its leaves
    numbered from ``first``; and the next free number."""
    axis, cut, left, right = [], [], [], []

    def node(rows: np.ndarray, share: int) -> int:
        nonlocal first
        me = len(axis)
        axis.append(-1), cut.append(0.0), left.append(0), right.append(0)
        if share > 1 and len(rows) > 1:
            k = int(np.argmax(y[rows].var(axis=0)))
            at = float(np.median(y[rows, k]))
            low = y[rows, k] < at
            if low.any():
                axis[me], cut[me] = k, at
                left[me] = node(rows[low], share // 2)
                right[me] = node(rows[~low], share - share // 2)
                return me
        left[me] = first
        first += 1
        return me

    node(np.arange(len(y)), leaves)
    return Tree(np.array(axis), np.array(cut), np.array(left), np.array(right)), first


def rows_per_tile(d: int, cfg: EmbeddingDedupConfig) -> int:
    return max(1, min(cfg.block_rows, cfg.block_bytes // (8 * d)))


def forest(classes: DataFrame, sizes: dict[int, int], turn: dict, cfg: EmbeddingDedupConfig) -> dict[int, Tree]:
    total = sum(sizes.values())
    share = min(1.0, cfg.sample_rows / total)
    width = cfg.box_dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, at, x in _by_length(b):
                y = rotated(x, turn.get(d))[:, :width]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(y.ravel()), y.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), d, np.int32)), lists], names=["dim", "y"])

    place = F.pmod(F.xxhash64(F.lit(11), "key"), F.lit(1 << 30)) / float(1 << 30)
    some = classes.where(place < share).select("dim", "unit").mapInArrow(run, "dim int, y array<double>")
    taken = some.limit(2 * cfg.sample_rows).toPandas()  # about sample_rows rows of box_dims numbers
    out, first = {}, 0
    for d, n in sorted(sizes.items()):
        mine = taken[taken.dim == d]
        # a rare length may have no vector in the sample: one leaf
        y = np.array(mine.y.tolist(), dtype=np.float64).reshape(len(mine), min(d, cfg.box_dims))
        leaves = max(1, min(cfg.max_leaves * n // total, -(-n // rows_per_tile(d, cfg))))
        out[d], first = grow(y, leaves, first)
    return out


def placed(classes: DataFrame, trees: dict[int, Tree], turn: dict, subs: dict[int, int], width: int) -> DataFrame:
    """Adds leaf and sub (the tile inside a large leaf)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = np.zeros(len(b), np.int32)
            for d, at, x in _by_length(b):
                leaf[at] = trees[d].leaf(rotated(x, turn.get(d))[:, :width])
            parts = np.array([subs.get(k, 1) for k in leaf.tolist()], np.uint64)
            spread = b.column(b.schema.get_field_index("cid")).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            spread = (spread + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            sub = (spread % np.maximum(parts, 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf), pa.array(sub)], names=[*b.schema.names, "leaf", "sub"])

    rows = classes.select("cid", "copies", "dim", "unit")
    return rows.mapInArrow(run, "cid long, copies long, dim int, unit binary, leaf int, sub int")


TILE = (
    "leaf int, sub int, dim int, weight long, rep long, centre array<double>, radius double, "
    "lo array<double>, hi array<double>, ids binary, copies binary, units binary"
)


def tiles(members: DataFrame, turn: dict, width: int) -> DataFrame:
    """One row a tile: its vectors packed, and the bounds over all of them."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cid")
        d = int(pdf.dim.iloc[0])
        packed = b"".join(pdf.unit)
        x = np.frombuffer(packed, np.float64).reshape(-1, d)
        y = rotated(x, turn.get(d))[:, :width]
        centre = x.mean(axis=0)
        return pd.DataFrame({
            "leaf": [pdf.leaf.iloc[0]], "sub": [pdf["sub"].iloc[0]], "dim": [d], "weight": [pdf.copies.sum()], "rep": [pdf.cid.iloc[0]],
            "centre": [centre], "radius": [float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max())],
            "lo": [y.min(axis=0)], "hi": [y.max(axis=0)],
            "ids": [pdf.cid.to_numpy(np.int64).tobytes()], "copies": [pdf.copies.to_numpy(np.int64).tobytes()], "units": [packed],
        })

    return members.groupBy("leaf", "sub").applyInPandas(pack, TILE)


def leaf_pairs(boxes: pd.DataFrame, dim_of: dict[int, int], reach: float) -> pd.DataFrame:
    """Pairs of leaves (la <= lb) of one length whose boxes come within ``reach``."""
    out = []
    for d in sorted(set(dim_of.values())):
        mine = boxes[boxes.leaf.map(dim_of) == d].sort_values(["leaf", "pos"])
        leaves = mine.leaf.unique()
        lo = mine.lo.to_numpy().reshape(len(leaves), -1)
        hi = mine.hi.to_numpy().reshape(len(leaves), -1)
        for k in range(len(leaves)):
            gap = np.maximum(0, np.maximum(lo[k:] - hi[k], lo[k] - hi[k:]))
            near = (gap * gap).sum(axis=1) <= reach * reach + ROUNDING
            out.append(pd.DataFrame({"la": leaves[k], "lb": leaves[k:][near]}))
    return pd.concat(out).astype("int32")


def routes(meta: DataFrame, dim_of: dict[int, int], threshold: float) -> DataFrame:
    """(la, sa, lb, sb, every): pairs of tiles that can hold links; ``every``
    where all their vectors must link."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))  # the distance of unit vectors at the threshold
    spans = meta.select("leaf", F.posexplode(F.arrays_zip("lo", "hi")).alias("pos", "b"))
    boxes = spans.groupBy("leaf", "pos").agg(F.min("b.lo").alias("lo"), F.max("b.hi").alias("hi")).toPandas()  # leaves * box_dims rows
    spark = meta.sparkSession
    pairs = spark.createDataFrame(leaf_pairs(boxes, dim_of, reach))
    side = lambda k: meta.select(*[F.col(c).alias(c + k) for c in ("leaf", "sub", "centre", "radius", "lo", "hi")])
    both = pairs.join(side("a"), F.col("la") == F.col("leafa")).join(side("b"), F.col("lb") == F.col("leafb"))
    both = both.where((F.col("la") < F.col("lb")) | (F.col("suba") <= F.col("subb")))
    add = lambda a, x: a + x
    gap = lambda lo, hi: F.zip_with(lo, hi, lambda x, y: F.greatest(F.lit(0.0), x - y))
    boxed = F.zip_with(gap("loa", "hib"), gap("lob", "hia"), lambda x, y: x * x + y * y)  # one of the two is 0
    apart = F.sqrt(F.aggregate(F.zip_with("centrea", "centreb", lambda x, y: (x - y) * (x - y)), F.lit(0.0), add))
    radii = F.col("radiusa") + F.col("radiusb")
    near = (F.aggregate(boxed, F.lit(0.0), add) <= reach * reach + ROUNDING) & (apart - radii <= reach + ROUNDING)
    return both.where(near).select(
        "la", F.col("suba").alias("sa"), "lb", F.col("subb").alias("sb"), (apart + radii < reach - ROUNDING).alias("every")
    )


# --- comparison ---------------------------------------------------------------


def _steps(d: int, lead: int) -> list[int]:
    out = [min(lead, d)]
    while out[-1] < d:
        out.append(min(d, 2 * out[-1]))
    return out


def _suffix_norms(y: np.ndarray, steps: list[int]) -> list[np.ndarray]:
    return [np.sqrt((y[:, k:] ** 2).sum(axis=1)) for k in steps]


def linked_pairs(xa: np.ndarray, xb: np.ndarray, turn: np.ndarray | None, same: bool, cfg: EmbeddingDedupConfig) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i, j) of all linked pairs, strip by strip; ``same``: only i < j."""
    t, strip = cfg.threshold, cfg.strip
    ya, yb = rotated(xa, turn), rotated(xb, turn)
    steps = _steps(ya.shape[1], cfg.lead)
    ra, rb = _suffix_norms(ya, steps), _suffix_norms(yb, steps)
    k = steps[0]
    # The suffix norm as one more component adds its product to the bound.
    fa = np.concatenate([ya[:, :k], ra[0][:, None]], axis=1).astype(np.float32)
    fb = np.concatenate([yb[:, :k], rb[0][:, None]], axis=1).astype(np.float32)
    for p in range(0, len(ya), strip):
        for q in range(p if same else 0, len(yb), strip):
            bound = fa[p : p + strip] @ fb[q : q + strip].T
            i, j = np.nonzero(bound >= np.float32(t - 1e-5))  # single precision: a wider margin
            i, j = i + p, j + q
            if same:
                i, j = i[i < j], j[i < j]
            if len(i) * 16 > bound.size:  # many are left: the whole product is cheaper
                value = (ya[p : p + strip] @ yb[q : q + strip].T)[i - p, j - q]
            else:
                value = np.einsum("ij,ij->i", ya[i, :k], yb[j, :k])
                for s in range(1, len(steps)):
                    on = value + ra[s - 1][i] * rb[s - 1][j] >= t - ROUNDING
                    i, j, value = i[on], j[on], value[on]
                    c = slice(steps[s - 1], steps[s])
                    value = value + np.einsum("ij,ij->i", ya[i, c], yb[j, c])
            close = np.abs(value - t) <= ROUNDING
            if close.any():
                value[close] = np.einsum("ij,ij->i", xa[i[close]], xb[j[close]])
            hit = value >= t
            if hit.any():
                yield i[hit], j[hit]


def join_roots(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of ``label`` (each node's root) that a pair connects."""
    while len(a):
        a, b = label[a], label[b]
        differ = a != b
        a, b = a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def compare(turn: dict, cfg: EmbeddingDedupConfig):
    """Task body for one pair of tiles: (u, v, n) a vector u with links, the
    root v of its linked set in this pair, and the rows it links to."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["leaf", "sub"])
        d = int(pdf.dim.iloc[0])
        ids = [np.frombuffer(x, np.int64) for x in pdf.ids]
        copies = [np.frombuffer(x, np.int64) for x in pdf.copies]
        x = [np.frombuffer(u, np.float64).reshape(-1, d) for u in pdf.units]
        same = len(pdf) == 1
        shift = 0 if same else len(ids[0])
        node, weight = np.concatenate(ids), np.concatenate(copies)
        n = np.zeros(len(node), np.int64)
        label = np.arange(len(node))
        for i, j in linked_pairs(x[0], x[-1], turn.get(d), same, cfg):
            j = j + shift
            n += np.bincount(i, weight[j], len(n)).astype(np.int64) + np.bincount(j, weight[i], len(n)).astype(np.int64)
            join_roots(label, i, j)
        on = n > 0
        return pd.DataFrame({"u": node[on], "v": node[label[on]], "n": n[on]})

    return run


def class_links(classes: DataFrame, cfg: EmbeddingDedupConfig) -> tuple[DataFrame, DataFrame]:
    """((cid, n): rows of other classes linked to, edges (u, v) of linked classes)."""
    spark = classes.sparkSession
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a vector length
    if not sizes:
        return spark.createDataFrame([], "cid long, n long"), spark.createDataFrame([], "u long, v long")
    turn = rotations(classes, sorted(sizes, key=lambda d: (-sizes[d], d)), cfg)
    trees = forest(classes, sizes, turn, cfg)
    dim_of = {int(k): d for d, t in trees.items() for k in t.left[t.axis < 0]}
    width = cfg.box_dims
    counts = placed(classes, trees, turn, {}, width).groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    subs = {r["leaf"]: -(-r["n"] // rows_per_tile(dim_of[r["leaf"]], cfg)) for r in counts.collect()}  # at most max_leaves + lengths rows
    members = placed(classes, trees, turn, subs, width)
    tile = written(tiles(members, turn, width), "vec-tiles")
    meta = tile.select("leaf", "sub", "weight", "rep", "centre", "radius", "lo", "hi")
    route = written(routes(meta, dim_of, cfg.threshold), "vec-routes")

    pair = F.struct("la", "sa", "lb", "sb").alias("pair")
    ends = F.array(F.struct(F.col("la").alias("leaf"), F.col("sa").alias("sub")), F.struct(F.col("lb").alias("leaf"), F.col("sb").alias("sub")))
    open_ = route.where("not every").select(pair, F.explode(F.array_distinct(ends)).alias("t")).select("pair", "t.*")
    sent = open_.join(tile.select("leaf", "sub", "dim", "ids", "copies", "units"), ["leaf", "sub"])
    found = written(sent.groupBy("pair").applyInPandas(compare(turn, cfg), "u long, v long, n long"), "vec-links")

    # Pairs of tiles in which all vectors link: their weights, and edges over one vector each.
    full = route.where("every")
    ways = full.select(*[F.col(c) for c in ("la", "sa", "lb", "sb")]).unionByName(
        full.where("la <> lb or sa <> sb").select(F.col("lb").alias("la"), F.col("sb").alias("sa"), F.col("la").alias("lb"), F.col("sa").alias("sb")))
    other = meta.select(F.col("leaf").alias("lb"), F.col("sub").alias("sb"), F.col("weight").alias("w"), F.col("rep").alias("far"))
    own = (F.col("la") == F.col("lb")) & (F.col("sa") == F.col("sb"))
    extra = ways.join(other, ["lb", "sb"]).groupBy(F.col("la").alias("leaf"), F.col("sa").alias("sub")).agg(
        F.sum("w").alias("w"), F.max(own.cast("long")).alias("own"), F.min("far").alias("far"))
    inside = written(members.select("cid", "copies", "leaf", "sub").join(extra, ["leaf", "sub"]).select(
        "cid", (F.col("w") - F.col("own") * F.col("copies")).alias("n"), "far"), "vec-inside")
    near = meta.select(F.col("leaf").alias("la"), F.col("sub").alias("sa"), F.col("rep").alias("near"))
    hubs = ways.join(other, ["lb", "sb"]).join(near, ["la", "sa"]).select(F.col("near").alias("u"), F.col("far").alias("v"))

    n = found.select(F.col("u").alias("cid"), "n").unionByName(inside.select("cid", "n")).groupBy("cid").agg(F.sum("n").alias("n"))
    edges = found.select("u", "v").unionByName(inside.select(F.col("cid").alias("u"), F.col("far").alias("v"))).unionByName(hubs)
    return n, edges.where("u <> v")


def near_duplicates(vectors: DataFrame, cfg: EmbeddingDedupConfig = EmbeddingDedupConfig(),
                    id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per row."""
    rows = written(unit_rows(vectors, id_col, vec_col), "vec-rows")
    grouped = rows.where("key is not null").groupBy("key", "dim").agg(
        F.first("unit").alias("unit"), F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = written(grouped.withColumn("cid", F.monotonically_increasing_id()), "vec-classes")
    n, edges = class_links(classes, cfg)
    roots = connected_components(edges)
    named = classes.select("key", "cid", "first", "copies").join(n, "cid", "left").join(
        roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "key", "first", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "cid").alias("root"))
    named = written(named, "vec-named")
    least = named.groupBy("root").agg(F.min("first").alias("component"), F.count(F.lit(1)).alias("classes"))
    total = max(1, named.count())
    known = join_split(named, least, "root", "classes", total).select(
        F.col("key"), "component", (F.col("n") + F.col("copies") - 1).alias("links"), "copies")
    out = join_split(rows.select("vec_id", "key"), known, "key", "copies", max(1, rows.count()))
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
