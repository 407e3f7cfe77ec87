"""SimHash near duplicates by generalised pigeonhole.

Fingerprints: the majority bit over the hashes of all word shingles. Two
fingerprints link when at most ``max_bits`` bits differ; documents reachable
over links form a group.

Candidate search on distinct fingerprints:

1. Bit statistics over all fingerprints (a 64 x 64 co-occurrence table) order
   the bits so that correlated ones stand together, in four blocks of 16.
2. A histogram of each block's values (at most 4 * 2**16 rows whatever the
   input) gives the number of pairs at each distance inside a block (an XOR
   convolution), and from these the expected candidates of any partition and
   threshold.
3. Dynamic programming picks the partitions (unions of neighbouring blocks)
   and their thresholds t_i >= -1 with sum(t_i + 1) = max_bits + 1, the
   generalised pigeonhole condition, at least estimated cost. Every choice
   finds every link; only the cost differs.
4. Each fingerprint is stored under its partition values and probes the values
   within the partition's threshold. Only the flips whose highest flipped bit
   is set are probed, so each pair meets once. Candidates are verified on all
   64 bits inside the task; a task passes on a spanning star per linked set,
   never all pairs.

Keys with very many members are split before the shuffle by pieces of the bits
that vary among them, again by pigeonhole, so no link is lost, and again as long
as a key stays too large.

Defined results: a text without words has fingerprint 0 and is linked like any
other; fewer words than the shingle length give one shingle; null ids are kept
and their component id is the smallest id of the group that is not null (null
when there is none); repeated rows each get a row; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.components import connected_components
from vantage.llm.shared import join_split, with_locators, written

BLOCKS, WIDTH = 4, 16  # the 64 bits as four blocks
PAIRS_AT_ONCE = 1 << 18  # candidates a task holds while it verifies them
HASH_SEED = 42


@dataclass(frozen=True)
class SimHashConfig:
    shingle_words: int = 3
    max_bits: int = 3
    # Cost of one stored or probed key (shuffled and sorted) and of one verified
    # candidate (a few vectorised operations), for the choice of partitions.
    key_cost: float = 1.0
    pair_cost: float = 0.02
    # The most keys a fingerprint may have, on average, in one partition.
    max_keys: int = 64
    # Costs are compared for this many fingerprints with the distances found,
    # so that the choice doesn't change while a corpus grows.
    design_rows: float = 1e9
    # A key with more than this share of all rows (4096 rows at least) is
    # split; at most 1 / share keys are.
    split_share: float = 1e-4
    split_least: int = 4096


def fingerprint(text: str | None, words_per: int = 3) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - words_per + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 14):  # shingles at a time
        some = words[k : k + (1 << 14) + words_per - 1]
        joined = b" ".join(some)
        ends = np.cumsum([len(w) + 1 for w in some]) - 1
        m = max(1, len(some) - words_per + 1)
        starts = np.concatenate([[0], ends[:-1] + 1])[:m].tolist()
        stops = ends[words_per - 1 :].tolist() if len(some) >= words_per else [len(joined)]
        hashes = np.fromiter((digest(joined[a:b], HASH_SEED) for a, b in zip(starts, stops)), np.uint64, m)
        part = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) and the columns ``keep``, one
    row per document row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words_per) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", *keep])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *keep)
    more = "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(run, f"doc_id long, fp long{more}")


# --- statistics and the choice of partitions ---------------------------------


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_order(fps: DataFrame) -> list[int]:
    """The 64 bits with correlated ones together, block after block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((64, 64))
        for b in batches:
            x = _bits(b.column(0).to_numpy(zero_copy_only=False)).astype(np.float32)
            both += x.T @ x
        i, j = np.divmod(np.arange(4096), 64)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(both.ravel().astype(np.int64))], names=["i", "j", "n"])

    table = fps.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    n = max(1, fps.count())
    both = np.zeros((64, 64))
    for r in table.collect():  # 4,096 rows
        both[r.i, r.j] = r.n / n
    mean = np.diag(both)
    cov = both - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    tie = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(tie, 0)
    left, order = set(range(64)), []
    for _ in range(BLOCKS):
        first = max(sorted(left), key=lambda i: max(tie[i, j] for j in left))
        block = [first]
        while len(block) < WIDTH:
            rest = sorted(left - set(block))
            block.append(max(rest, key=lambda i: sum(tie[i, j] for j in block)))
        order += block
        left -= set(block)
    return order


def reordered(fps: DataFrame, order: list[int]) -> DataFrame:
    """Adds ``x``: the fingerprint with its bits in ``order``, lowest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = _bits(b.column(0).to_numpy(zero_copy_only=False))[:, order]
            x = np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view("<i8").ravel()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x)], names=["fp", "x"])

    return fps.select("fp").mapInArrow(run, "fp long, x long")


def block_distances(histogram: np.ndarray, upto: int) -> np.ndarray:
    """Ordered pairs (a value with itself included) at distance 0..upto."""
    h = histogram.astype(np.float64)
    step = 1
    while step < len(h):  # Walsh-Hadamard transform
        h = h.reshape(-1, 2, step)
        h = np.stack([h[:, 0] + h[:, 1], h[:, 0] - h[:, 1]], axis=1).ravel()
        step *= 2
    h = h * h
    step = 1
    while step < len(h):
        h = h.reshape(-1, 2, step)
        h = np.stack([h[:, 0] + h[:, 1], h[:, 0] - h[:, 1]], axis=1).ravel()
        step *= 2
    weight = np.bitwise_count(np.arange(len(h), dtype=np.uint64))
    return np.array([h[weight == d].sum() for d in range(upto + 1)]) / len(h)


def _masks(width: int, t: int) -> int:
    return sum(comb(width, d) for d in range(1, t + 1))


def choose_partitions(pairs: list[np.ndarray], found: int, cfg: SimHashConfig) -> list[tuple[int, int, int]]:
    """[(first bit, width, threshold)] of least estimated cost.

    ``pairs``: for each block, ordered pairs by distance among the ``found``
    fingerprints, each with itself included. Dynamic programming over blocks
    and credits used (a partition of threshold t uses t + 1).
    """
    most = cfg.max_keys
    while (chosen := _cheapest(pairs, found, cfg, most)) is None:
        most *= 2  # many bits need more keys than asked for
    return chosen


def _cheapest(pairs: list[np.ndarray], found: int, cfg: SimHashConfig, most: int) -> list[tuple[int, int, int]] | None:
    n = cfg.design_rows
    # Share of pairs of different fingerprints at each distance in a block,
    # drawn towards that of random bits by as many pairs as a block has values.
    chance = np.array([comb(WIDTH, d) for d in range(cfg.max_bits + 1)]) / 2.0**WIDTH
    itself = np.eye(1, cfg.max_bits + 1)[0] * found
    share = [(p - itself + chance * 2.0**WIDTH) / (float(found) * max(0, found - 1) + 2.0**WIDTH) for p in pairs]
    spend = cfg.max_bits + 1
    best: dict[tuple[int, int], tuple[float, list]] = {(0, 0): (0.0, [])}
    for end in range(1, BLOCKS + 1):
        for used in range(spend + 1):
            options = []
            for begin in range(end):
                dist = np.array([1.0])
                for b in range(begin, end):
                    dist = np.convolve(dist, share[b])[: cfg.max_bits + 1]
                width = (end - begin) * WIDTH
                for credit in range(used + 1):
                    t = credit - 1
                    if (begin, used - credit) not in best:
                        continue
                    cost = 0.0
                    if t >= 0:
                        each = 1 + _masks(width, t) / 2
                        if each > most and t > 0:
                            continue
                        keys = n * each
                        met = n * (n - 1) / 2 * dist[: t + 1].sum()
                        cost = cfg.key_cost * keys + cfg.pair_cost * met
                    before, parts = best[begin, used - credit]
                    part = [(begin * WIDTH, width, t)] if t >= 0 else []
                    options.append((before + cost, parts + part))
            if options:
                best[end, used] = min(options, key=lambda o: (o[0], o[1]))
    return best[BLOCKS, spend][1] if (BLOCKS, spend) in best else None


def plan(fps: DataFrame, cfg: SimHashConfig) -> tuple[list[int], list[tuple[int, int, int]]]:
    order = bit_order(fps)
    x = reordered(fps, order)
    values = F.array(*[
        F.struct(F.lit(b).alias("b"), F.shiftright("x", b * WIDTH).bitwiseAND(F.lit((1 << WIDTH) - 1)).alias("v"))
        for b in range(BLOCKS)
    ])
    counts = x.select(F.explode(values).alias("e")).groupBy("e.b", "e.v").agg(F.count(F.lit(1)).alias("n"))
    table = np.zeros((BLOCKS, 1 << WIDTH))
    found = counts.toPandas()  # at most 4 * 2**16 rows
    table[found.b, found.v] = found.n
    pairs = [block_distances(h, cfg.max_bits) for h in table]
    return order, choose_partitions(pairs, int(table[0].sum()), cfg)


# --- probing and verifying ----------------------------------------------------


def _flips(width: int, t: int) -> list[int]:
    return [sum(1 << b for b in c) for d in range(1, t + 1) for c in combinations(range(width), d)]


def keys(x: DataFrame, parts: list[tuple[int, int, int]]) -> DataFrame:
    """(key, probe, x): each fingerprint under its partition values (probe 0)
    and under the values it probes (probe 1). ``key`` hashes (partition,
    value); a chance collision only adds candidates to verify."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [np.array([0, *_flips(w, t)], np.uint64) for _, w, t in parts]
        tops = [np.array([0] + [1 << (m.bit_length() - 1) for m in f[1:].tolist()], np.uint64) for f in masks]
        for b in batches:
            every = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for k, (lo, w, _) in enumerate(parts):
                step = max(1, (1 << 17) // len(masks[k]))
                for at in range(0, len(every), step):
                    x = every[at : at + step]
                    own = (x >> np.uint64(lo)) & np.uint64(2**w - 1)
                    # stored under its own value, probing the flips whose top bit is set
                    probes = (own[:, None] & tops[k]) != 0
                    probes[:, 0] = True
                    row, which = np.nonzero(probes)
                    yield _key_rows(k, own[row] ^ masks[k][which], (which > 0).astype(np.int32), x[row])

    return x.select("x").mapInArrow(run, "key long, probe int, x long")


def _mixed(v: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, so that keys spread evenly."""
    v = (v ^ (v >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    v = (v ^ (v >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return v ^ (v >> np.uint64(32))


def _key_rows(k: int, value: np.ndarray, probe: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    key = _mixed(_mixed(value) + np.uint64(k + 1)).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(probe), pa.array(x.view(np.int64))], names=["key", "probe", "x"])


def _pieces(varying: int, n: int) -> list[int]:
    """The set bits of ``varying`` dealt into ``n`` masks, as signed longs."""
    bits = [b for b in range(64) if varying >> b & 1]
    masks = [sum(1 << b for b in bits[i::n]) for i in range(n)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def split_hot(rows: DataFrame, cfg: SimHashConfig) -> DataFrame:
    """(key, probe, x) with the keys of very many rows split, level by level.

    The two sides of a link differ by at most max_bits bits, all of them among
    the bits that vary inside the key. These bits are dealt into max_bits + 1
    pieces, so one piece is equal on both sides, and each row goes under
    (key, piece, value of the piece). The bits of a piece are constant inside
    the new key, so every level has fewer varying bits; as the rows of a key are
    distinct fingerprints, a key that is still too large has bits to split by.
    """
    out, now, level = None, rows, 0
    limit = cfg.split_least
    while True:
        facts = now.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_or("x").alias("any"), F.bit_and("x").alias("all"))
        large = written(facts.where(F.col("n") > limit), "simhash-hot")
        if level == 0 and not large.isEmpty():
            limit = max(limit, now.count() * cfg.split_share)  # at most 1 / split_share keys are above
        plan = []
        for r in large.where(F.col("n") > limit).collect():
            varying = (r["any"] ^ r["all"]) & ((1 << 64) - 1)
            if varying.bit_count() > cfg.max_bits:  # else all are within max_bits of each other, and few
                plan.append((r["key"], _pieces(varying, cfg.max_bits + 1)))
        if not plan:
            return now if out is None else out.unionByName(now)
        hot = now.sparkSession.createDataFrame(plan, "h long, masks array<long>")
        marked = now.join(F.broadcast(hot), F.col("key") == F.col("h"), "left")
        cold = marked.where("h is null").select("key", "probe", "x")
        out = cold if out is None else out.unionByName(cold)
        pieces = F.transform("masks", lambda m, i: F.xxhash64("key", F.lit(level), i, F.col("x").bitwiseAND(m)))
        now = written(marked.where("h is not null").select(F.explode(pieces).alias("key"), "probe", "x"), "simhash-split")
        level += 1


def links(x: DataFrame, parts: list[tuple[int, int, int]], cfg: SimHashConfig) -> DataFrame:
    """(u, v): spanning stars of the linked fingerprints found in each task."""
    rows = split_hot(keys(x, parts), cfg)
    bound = cfg.max_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for b in batches:
            part = tuple(c.to_numpy(zero_copy_only=False) for c in b.columns)
            if size >= 1 << 17 and len(part[0]):
                # close at the last key change, carry the open key on
                same = part[0] == held[-1][0][-1]
                cut = int(np.argmin(same)) if not same.all() else len(same)
                held.append(tuple(p[:cut] for p in part))
                if cut < len(same):
                    yield _verified(held, bound)
                    held, size = [], 0
                    part = tuple(p[cut:] for p in part)
            held.append(part)
            size += len(part[0])
        if held:
            yield _verified(held, bound)

    return rows.repartition("key").sortWithinPartitions("key", "probe").mapInArrow(run, "u long, v long")


def _verified(held: list[tuple[np.ndarray, ...]], bound: int) -> pa.RecordBatch:
    key, probe, x = (np.concatenate([h[i] for h in held]) for i in range(3))
    x = x.astype(np.int64).view(np.uint64)
    n = len(key)
    us: list[np.ndarray] = []
    vs: list[np.ndarray] = []
    if n:
        first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
        stored = np.add.reduceat((probe == 0).astype(np.int64), first)
        begin = first[group]
        # a stored row meets the stored rows before it, a probe all stored rows
        meets = np.where(probe == 0, np.arange(n) - begin, stored[group])
        ends = np.cumsum(meets)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + PAIRS_AT_ONCE, "right")))
            m = meets[at:to]
            left = np.repeat(np.arange(at, to), m)
            right = np.arange(len(left)) - np.repeat(ends[at:to] - m - base, m) + begin[left]
            near = np.bitwise_count(x[left] ^ x[right]) <= bound
            if near.any():
                u, v = _stars(x[left[near]], x[right[near]])
                us.append(u)
                vs.append(v)
            at = to
    u = np.concatenate(us) if us else np.zeros(0, np.uint64)
    v = np.concatenate(vs) if vs else np.zeros(0, np.uint64)
    if len(us) > 1:
        u, v = _stars(u, v)
    return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with one edge per node: (node, its root)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    move = label != np.arange(len(nodes))
    return nodes[move], nodes[label[move]]


def groups(docs: DataFrame, cfg: SimHashConfig, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp, root (a fingerprint that names the group), component_id and
    the columns ``keep``, one row per row."""
    rows = written(fingerprints(docs, cfg.shingle_words, keep), "simhash-rows")
    fps = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "simhash-fps")
    order, parts = plan(fps, cfg)
    x = written(reordered(fps, order), "simhash-bits")
    roots = connected_components(links(x, parts, cfg)).withColumnRenamed("node", "x")
    member = x.join(roots, "x", "left").select("fp", F.coalesce("root", "x").alias("root"))
    member = written(fps.join(member, "fp"), "simhash-member")
    least = member.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("fps"))
    named = join_split(member, least, "root", "fps", max(1, fps.count()))
    named = named.select("fp", "root", "copies", "component_id")
    return join_split(rows, named, "fp", "copies", max(1, rows.count()))


def near_duplicates(docs: DataFrame, cfg: SimHashConfig = SimHashConfig()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per row."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups(docs, cfg).select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, cfg: SimHashConfig = SimHashConfig()) -> DataFrame:
    """One row of each group, all columns: that of the smallest id (rows
    without one come last), and of rows repeating that id the first by file and
    row. Rows are told apart by their place, so a repeated id never takes a row
    of another group along."""
    rows = with_locators(docs)
    found = groups(rows.select("row.doc_id", "row.text", "loc_file", "loc_row"), cfg, ("loc_file", "loc_row"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "loc_file", "loc_row")).alias("f")
    stay = found.groupBy("root").agg(first).select("f.loc_file", "f.loc_row")
    return rows.join(stay, ["loc_file", "loc_row"], "left_semi").select("row.*")
