"""Removal of repeated byte strings by external induced sorting.

A byte goes when it lies in a string of ``length`` bytes that also starts
somewhere else, in the same or another document. Every window of that length
is placed in a sorted order of suffixes, with the common prefix to its
neighbours; a common prefix of at least ``length`` means a repeat.

Cutting the corpus into shards. A window's anchor is the gram of 32 bytes in
it with the smallest hash (the first of equals), a function of the window's
bytes alone: equal windows have equal anchors at equal distances. Consecutive
windows with one anchor form a segment; a segment goes to the shard of its
anchor's hash, so all places of a string meet in one shard. Anchors that occur
once in the corpus have no partner and stay out. Identical segments are sent
once with their count. Nothing depends on where documents begin or end.

A class (all segments of one anchor) of more than ``shard_bytes`` is cut by
content: windows whose distance from the anchor lies in one range of ``span``
values share ``length - span + 1`` bytes around the anchor, so each segment is
cut at the ranges' borders and each piece goes to the class of its range and
those bytes. Equal windows meet as before, and equal pieces are again sent once.
Classes still too large are cut with smaller spans; at span 1 a class is one
window, a single row with its count.

Inside a shard the segments of one anchor gram are a class, aligned on the
anchor. Suffixes are sorted by induction from right to left: the order of the
suffixes that start at distance x from the anchor follows from the order at
x + 1. Each suffix tuple (class, order, segment, common prefix) is pushed under
the byte before it into a priority queue; popping by (class, byte, order) gives
the order at x. The common prefix of neighbours that share that byte is one
more than the smallest one between them in the order before, which the scan
carries per byte, also across the blocks it reads. The queue writes sorted
runs to the task's own temporary folder when it holds more than a set number of
tuples. The text of a class of more than ``memory_bytes`` goes from the Arrow
batches straight to a file there, from which it is mapped, and so are its marks:
in memory are some 60 bytes for each of its segments and the queue's tuples. The
files go when the class is done; a lost executor repeats its task.

Defined results: a null text is empty; texts shorter than ``length`` keep all
bytes; rows repeated (with or without ids) are documents of their own, so all
their windows repeat; an empty table gives an empty result; extra columns are
not read. Grams and segments are told apart by 64-bit hashes each, compared
together (128 bits); the suffix order compares bytes.
"""

from __future__ import annotations

import hashlib
import mmap
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.shared import discard, join_split, written

GRAM = 32  # bytes of an anchor
MULT = np.uint64(0x9E3779B97F4A7C15)
NO_PREFIX = np.int32(2**30)  # above every common prefix


@dataclass(frozen=True)
class SuffixConfig:
    """``block_bytes`` of segment text are sorted at a time; a class with more
    than ``memory_bytes`` goes by disk, ``queue_rows`` tuples in memory; one with
    more than ``shard_bytes`` is cut by content first."""

    length: int = 200
    scan_bytes: int = 1 << 17
    block_bytes: int = 8 << 20
    memory_bytes: int = 64 << 20
    shard_bytes: int = 512 << 20
    queue_rows: int = 1 << 21


# --- anchors and segments ------------------------------------------------------


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes that start at each position (positions
    too near the end get a hash of fewer bytes; they are never used)."""
    h = (text.astype(np.uint64) + np.uint64(1)) * MULT
    power, span = MULT, 1
    while span < GRAM:
        shifted = np.zeros_like(h)
        shifted[:-span] = h[span:]
        with np.errstate(over="ignore"):
            h = h * power + shifted
            power = power * power
        span *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def anchors(hashes: np.ndarray, length: int) -> np.ndarray:
    """For each window start, the position of the gram with the smallest hash
    in the window (the first of equals); 32 bits of the hash are compared."""
    width = length - GRAM + 1
    n = len(hashes)
    best = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        best[:-span] = np.minimum(best[:-span], best[span:])
        span *= 2
    rest = width - span
    if rest:
        best[:-rest] = np.minimum(best[:-rest], best[rest:])
    return (best & np.uint64(0xFFFFFFFF)).astype(np.int64)


def block_segments(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text number, begin, windows, anchor offset, gram hash, digest) of every
    segment of the texts."""
    import xxhash

    raw = b"".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    hashes = gram_hashes(np.frombuffer(raw, np.uint8))
    anchor = anchors(hashes, length)
    number = np.repeat(np.arange(len(texts)), np.maximum(0, sizes - length + 1))
    first = ends - sizes
    counts = np.maximum(0, sizes - length + 1)
    start = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts) + first[number]
    a = anchor[start]
    new = np.flatnonzero((np.diff(a, prepend=-1) != 0) | (np.diff(number, prepend=-1) != 0))
    windows = np.diff(np.append(new, len(start)))
    begin, number, a = start[new], number[new], a[new]
    digest = xxhash.xxh3_64_intdigest
    stops = begin + windows + length - 1
    marks = np.fromiter((digest(raw[i:j]) for i, j in zip(begin.tolist(), stops.tolist())), np.uint64, len(begin))
    return number, begin - first[number], windows, a - begin, hashes[a], marks


PLACE = "f long, r long"
SEGMENT = "gram long, mark long, begin int, windows int, off int"


def segments(rows: DataFrame, cfg: SuffixConfig) -> DataFrame:
    """One row per segment of every text: place of its row, gram, mark,
    begin, windows, off (bytes from the segment's begin to its anchor)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f, r, texts in _blocks(batches, cfg.scan_bytes):
            number, begin, windows, off, gram, mark = block_segments(texts, cfg.length)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(f)[number]), pa.array(np.array(r)[number]), pa.array(gram.view(np.int64)),
                    pa.array(mark.view(np.int64)), pa.array(begin, pa.int32()), pa.array(windows, pa.int32()), pa.array(off, pa.int32()),
                ],
                names=["f", "r", "gram", "mark", "begin", "windows", "off"],
            )

    return rows.select("f", "r", "text").mapInArrow(run, f"{PLACE}, {SEGMENT}")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list, list[bytes]]]:
    f, r, texts, held = [], [], [], 0
    for b in batches:
        for x, y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            text = (t.as_py() or "").encode("utf-8", "surrogatepass")
            f.append(x)
            r.append(y)
            texts.append(text)
            held += len(text)
            if held >= size:
                yield f, r, texts
                f, r, texts, held = [], [], [], 0
    if texts:
        yield f, r, texts


# --- external induced sorting ----------------------------------------------------


class TupleQueue:
    """Bulk priority queue of suffix tuples. Tuples pushed under equal keys
    come out in the order they went in. What exceeds ``limit`` tuples is
    written to ``folder`` in sorted runs."""

    def __init__(self, limit: int, folder: str | None):
        self.limit, self.folder = limit, folder
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0
        self.runs: list[tuple[np.ndarray, ...]] = []
        self.files: list[str] = []

    def push(self, key: np.ndarray, seg: np.ndarray, lcp: np.ndarray) -> None:
        self.held.append((key, seg, lcp))
        self.size += len(key)
        if self.folder and self.size > self.limit:
            self._spill()

    def _sorted(self) -> tuple[np.ndarray, ...]:
        key, seg, lcp = self.held[0] if len(self.held) == 1 else (np.concatenate(x) for x in zip(*self.held))
        # byte first, class second: both passes are stable radix sorts
        order = np.argsort((key & 0xFF).astype(np.uint8), kind="stable")
        order = order[np.argsort((key[order] >> 8).astype(np.uint16), kind="stable")]
        self.held, self.size = [], 0
        return key[order], seg[order], lcp[order]

    def _spill(self) -> None:
        arrays = []
        for x in self._sorted():
            handle, path = tempfile.mkstemp(dir=self.folder)
            os.close(handle)
            x.tofile(path)
            self.files.append(path)
            arrays.append(np.memmap(path, x.dtype, "r"))
        self.runs.append(tuple(arrays))

    def pop_all(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(key, seg, lcp) blocks in order; frees the runs."""
        if not self.runs:
            if self.held:
                yield self._sorted()
            return
        if self.held:
            self._spill()
        keys = np.unique(np.concatenate([np.unique(run[0]) for run in self.runs]))
        for key in keys:
            for run in self.runs:
                a, b = np.searchsorted(run[0], [key, key + 1])
                for k in range(a, b, self.limit):
                    yield tuple(np.array(x[k : min(b, k + self.limit)]) for x in run)
        self.runs = []
        for path in self.files:
            os.unlink(path)
        self.files = []


class Carry:
    """Smallest common prefix since each byte was last seen in the class that
    a block of the scan left open (-1: not seen)."""

    def __init__(self) -> None:
        self.cls = -1
        self.least = np.full(256, -1, np.int32)


def induce(cls: np.ndarray, char: np.ndarray, lcp: np.ndarray, carry: Carry) -> np.ndarray:
    """Common prefix of each suffix, extended by ``char`` to the left, with
    the suffix before it in the new order (0 when that has another byte or
    class). Rows are in the old order; ``lcp`` is to the row before."""
    n = len(cls)
    key = (cls.astype(np.int64) << 8) | char
    order = np.argsort(char, kind="stable")
    order = order[np.argsort(cls[order].astype(np.uint16), kind="stable")]
    sorted_key = key[order]
    same = np.zeros(n, bool)
    same[1:] = sorted_key[1:] == sorted_key[:-1]
    out = np.zeros(n, np.int32)
    cur, prev = order[same], order[np.flatnonzero(same) - 1]
    if len(cur):
        bounds = np.empty(2 * len(cur), np.int64)
        bounds[0::2], bounds[1::2] = prev + 1, cur + 1
        padded = np.append(lcp, np.int32(0))
        out[cur] = np.minimum.reduceat(padded, bounds)[0::2] + 1
    # the class left open by the block before
    head = int(np.searchsorted(cls, carry.cls, "right")) if cls[0] == carry.cls else 0
    if head:
        low = np.minimum.accumulate(lcp[:head])
        seen, at = np.unique(char[:head], return_index=True)
        known = carry.least[seen] >= 0
        out[at[known]] = np.minimum(carry.least[seen[known]], low[at[known]]) + 1
    # and the one this block leaves open
    last = cls[-1]
    begin = int(np.searchsorted(cls, last, "left"))
    if last != carry.cls:
        carry.cls, carry.least = last, np.full(256, -1, np.int32)
    elif head:
        open_bytes = carry.least >= 0
        carry.least[open_bytes] = np.minimum(carry.least[open_bytes], lcp[:head].min())
    suffix_min = np.minimum.accumulate(lcp[begin:][::-1])[::-1]
    seen, back = np.unique(char[begin:][::-1], return_index=True)
    at = n - begin - 1 - back
    after = np.append(suffix_min, np.int32(2**30))[at + 1]
    carry.least[seen] = after
    return out


def repeated_windows(
    cls: np.ndarray, off: np.ndarray, windows: np.ndarray, count: np.ndarray, text: np.ndarray, cfg: SuffixConfig,
    folder: str | None = None,
) -> np.ndarray:
    """Marks, segment after segment, of the windows that start anywhere else.

    Segments are ordered by class (numbers from 0 up, below 65,536); ``count``
    is how often each stands in the corpus; ``text`` holds them in a row. With
    a ``folder`` the queue and the marks live there.
    """
    length = cfg.length
    size = windows + length - 1
    base = np.cumsum(size) - size  # of a segment's text
    first_mark = np.cumsum(windows) - windows
    total = int(windows.sum())
    if folder:
        handle, path = tempfile.mkstemp(dir=folder)
        os.close(handle)
        marks = np.memmap(path, np.bool_, "w+", shape=(max(1, total),))
    else:
        marks = np.zeros(total, bool)
    end, low = size - off, -off  # places relative to the anchor
    by_end = np.argsort(-end, kind="stable")
    ends_sorted = -end[by_end]
    step = cfg.queue_rows if folder else max(1, len(cls))
    queue = TupleQueue(cfg.queue_rows, folder)
    for x in range(int(end.max()) - 1, int(low.min()) - 1, -1):
        # suffixes at x + 1 in order: those of the last round, and before them,
        # in each class, the empty suffixes of segments that end there
        a, b = np.searchsorted(ends_sorted, [-(x + 1), -x])
        fresh = np.sort(by_end[a:b])
        following = TupleQueue(cfg.queue_rows, folder)
        carry, gap = Carry(), Gap()
        for seg, lcp in _in_order(queue, fresh, cls, step, folder is not None):
            alive = low[seg] <= x
            # a suffix that ends its segment's way still separates neighbours
            if folder or not alive.all():
                lcp = _merge_gaps(lcp, alive, cls[seg], gap)
                seg = seg[alive]
                if not len(seg):
                    continue
            own = cls[seg]
            char = text[base[seg] + off[seg] + x]
            following.push((own.astype(np.int64) << 8) | char, seg, induce(own, char, lcp, carry))
        queue = _marked(following, x, base, first_mark, off, windows, count, marks, length, cfg, folder)
    return marks[:total]


class Gap:
    """What the blocks of a scan before this one leave open: the class of the
    last row that stayed, and the smallest common prefix passed over since."""

    def __init__(self) -> None:
        self.cls = -1
        self.least = NO_PREFIX


def _merge_gaps(lcp: np.ndarray, alive: np.ndarray, cls: np.ndarray, gap: Gap) -> np.ndarray:
    """Common prefixes among the rows that stay: the smallest one passed over,
    0 for the first of a class."""
    kept = np.flatnonzero(alive)
    if not len(kept):
        gap.least = min(gap.least, lcp.min(initial=NO_PREFIX))
        return lcp[:0]
    bounds = np.empty(2 * len(kept), np.int64)
    bounds[0::2] = np.concatenate([[0], kept[:-1] + 1])
    bounds[1::2] = kept + 1
    out = np.minimum.reduceat(np.append(lcp, np.int32(0)), bounds)[0::2]
    out[0] = min(out[0], gap.least)
    out[np.diff(cls[kept], prepend=gap.cls) != 0] = 0
    gap.cls, gap.least = cls[kept[-1]], lcp[kept[-1] + 1 :].min(initial=NO_PREFIX)
    return out


def _in_order(queue: TupleQueue, fresh: np.ndarray, cls: np.ndarray, step: int, external: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(segment, common prefix) blocks of the order at one place."""
    zero = np.zeros(len(fresh), np.int32)
    if external:  # one class: the empty suffixes come first
        for k in range(0, len(fresh), step):
            yield fresh[k : k + step], zero[k : k + step]
        for _, seg, lcp in queue.pop_all():
            yield seg, lcp
        return
    blocks = list(queue.pop_all())
    if not blocks:
        if len(fresh):
            yield fresh, zero
        return
    _, seg, lcp = blocks[0]
    if len(fresh):
        seg, lcp = np.concatenate([fresh, seg]), np.concatenate([zero, lcp])
        order = np.argsort(cls[seg].astype(np.uint16), kind="stable")
        seg, lcp = seg[order], lcp[order]
    yield seg, lcp


def _marked(following, x, base, first_mark, off, windows, count, marks, length, cfg, folder) -> TupleQueue:
    """Marks the windows at x from the new order and hands the order on."""
    out = TupleQueue(cfg.queue_rows, folder)
    last_seg, last_hit = None, False
    for key, seg, lcp in following.pop_all():
        near = lcp >= length
        hit = near.copy()
        hit[:-1] |= near[1:]
        if last_seg is not None and near[0] and not last_hit:
            _mark(marks, first_mark, off, x, np.array([last_seg]))
        window = off[seg] + x
        hit |= (count[seg] > 1) & (window < windows[seg])
        _mark(marks, first_mark, off, x, seg[hit])
        last_seg, last_hit = seg[-1], bool(hit[-1])
        out.push(key, seg, lcp)
    return out


def _mark(marks, first_mark, off, x, seg) -> None:
    marks[first_mark[seg] + off[seg] + x] = True


def _runs(marks: np.ndarray, step: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the marked runs; one that crosses a multiple of
    ``step`` comes in two."""
    lo, hi = [], []
    zero = np.zeros(1, np.int8)
    for k in range(0, len(marks), step):
        edge = np.diff(np.concatenate([zero, np.array(marks[k : k + step]).view(np.int8), zero]))
        lo.append(np.flatnonzero(edge == 1) + k)
        hi.append(np.flatnonzero(edge == -1) + k)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *lo]), np.concatenate([none, *hi])


FOUND = "gram long, mark long, copies long, lo int, hi int"


def sorted_shards(texts: DataFrame, cfg: SuffixConfig) -> DataFrame:
    """From (gram, mark, off, windows, copies, text) of distinct segments, the
    runs [lo, hi) of repeated window starts in each, counted from its begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(cfg)
        for b in batches:
            gram = b.column(0).to_numpy()
            ends = np.cumsum(pc.binary_length(b.column(5)).to_numpy(), dtype=np.int64)
            # rows that begin a class, and the text before them in this batch
            new = np.flatnonzero(np.diff(gram, prepend=gram[:1]) != 0)
            if len(gram) and block.last is not None and gram[0] != block.last:
                new = np.concatenate([[0], new])
            before = np.where(new > 0, ends[new - 1], 0)
            k = 0
            while k < len(b):
                # the block closes where a class begins behind its bound
                done = int(ends[k - 1]) if k else 0
                close = np.flatnonzero((block.size + before - done >= cfg.block_bytes) & (new >= k))
                to = int(new[close[0]]) if len(close) else len(b)
                block.add(b.slice(k, to - k))
                if len(close):
                    yield block.result()
                    block = _Block(cfg)
                    new, before = new[new > to], before[new > to]
                k = to
        if block.last is not None:
            yield block.result()

    columns = texts.select("gram", "mark", "off", "windows", "copies", "text")
    return columns.repartition("gram").sortWithinPartitions("gram").mapInArrow(run, FOUND)


class _Block:
    """Whole classes that are sorted together. Text beyond ``memory_bytes``
    goes to a file of the task."""

    def __init__(self, cfg: SuffixConfig):
        self.cfg = cfg
        self.rows: list[tuple[np.ndarray, ...]] = []
        self.size, self.last = 0, None
        self.text = tempfile.SpooledTemporaryFile(max_size=cfg.memory_bytes)

    def add(self, b: pa.RecordBatch) -> None:
        if not len(b):
            return
        self.rows.append(tuple(np.array(b.column(i).to_numpy(), np.int64) for i in range(5)))
        self.last = int(self.rows[-1][0][-1])
        column = b.column(5)
        offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(b) + 1]
        data = memoryview(column.buffers()[2] or b"")[int(offsets[0]) : int(offsets[-1])]
        self.text.write(data)
        self.size += len(data)

    def result(self) -> pa.RecordBatch:
        """The runs of repeated windows of the block's segments."""
        columns = [np.concatenate(c) for c in zip(*self.rows)]
        self.rows = []
        self.text.flush()
        if self.size > self.cfg.memory_bytes:
            self.text.rollover()
            raw = np.frombuffer(mmap.mmap(self.text.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
        else:
            self.text.seek(0)
            raw = np.frombuffer(self.text.read(), np.uint8)
        try:
            return _block_result(columns, raw, self.cfg)
        finally:
            del raw
            self.text.close()


def _block_result(columns: list[np.ndarray], raw: np.ndarray, cfg: SuffixConfig) -> pa.RecordBatch:
    gram, mark, off, windows, copies = columns
    cls = np.cumsum(np.diff(gram, prepend=gram[0]) != 0)
    # classes are numbered in 16 bits; a class beyond memory goes by disk alone
    big = np.bincount(cls, windows + cfg.length - 1) > cfg.memory_bytes
    edges = [0]
    for k in np.flatnonzero(np.diff(cls) != 0) + 1:
        if big[cls[k]] or big[cls[k - 1]] or cls[k] - cls[edges[-1]] >= 60_000:
            edges.append(int(k))
    edges.append(len(cls))
    place = np.concatenate([[0], np.cumsum(windows + cfg.length - 1)])
    first = np.cumsum(windows) - windows
    begins, ends = [], []
    for a, b in zip(edges, edges[1:]):
        args = (cls[a:b] - cls[a], off[a:b], windows[a:b], copies[a:b], raw[place[a] : place[b]], cfg)
        if big[cls[a]]:
            with tempfile.TemporaryDirectory() as folder:
                lo, hi = _runs(repeated_windows(*args, folder=folder))
        else:
            lo, hi = _runs(repeated_windows(*args))
        begins.append(lo + first[a])
        ends.append(hi + first[a])
    lo, hi = np.concatenate(begins), np.concatenate(ends)
    # a run may reach over segments: cut it at their borders
    one, last = (np.searchsorted(first, x, "right") - 1 for x in (lo, hi - 1))
    n = last - one + 1
    run = np.repeat(np.arange(len(lo)), n)
    seg = one[run] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    start, stop = np.maximum(lo[run], first[seg]), np.minimum(hi[run], first[seg] + windows[seg])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(gram[seg]), pa.array(mark[seg]), pa.array(copies[seg]),
            pa.array(start - first[seg], pa.int32()), pa.array(stop - first[seg], pa.int32()),
        ],
        names=["gram", "mark", "copies", "lo", "hi"],
    )


# --- the whole operator ------------------------------------------------------------


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, text and each row's place (file, row in the file)."""
    try:
        return docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
            F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"),
        )
    except AnalysisException:
        return placed(written(docs.select("doc_id", "text"), "suffix-input"))


def packed(rows: DataFrame) -> DataFrame:
    """The rows with their texts compressed, for shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = [press.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(z, pa.binary())], names=["f", "r", "doc_id", "z"])

    return rows.select("f", "r", "doc_id", "text").mapInArrow(run, f"{PLACE}, doc_id long, z binary")


def _unpacked(z: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z, max_output_size=1 << 31) if z else b""


def segment_texts(rows: DataFrame, wanted: DataFrame, cfg: SuffixConfig) -> DataFrame:
    """Texts of the segments ``wanted`` (f, r, begin, gram, mark, off, windows,
    copies)."""
    own = wanted.groupBy("f", "r").agg(F.collect_list(F.struct("begin", "gram", "mark", "off", "windows", "copies")).alias("s"))
    both = packed(rows).join(own, ["f", "r"]).select("z", "s.begin", "s.gram", "s.mark", "s.off", "s.windows", "s.copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                raw = _unpacked(b.column(0)[i].as_py())
                begin, windows = b.column(1)[i].as_py(), b.column(5)[i].as_py()
                part = [raw[k : k + w + cfg.length - 1] for k, w in zip(begin, windows)]
                cols = [b.column(c)[i].values for c in (2, 3, 4, 5, 6)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(part, pa.binary())], names=["gram", "mark", "off", "windows", "copies", "text"])

    return both.mapInArrow(run, "gram long, mark long, off int, windows int, copies long, text binary")


def spans(length: int) -> list[int]:
    """Numbers of anchor distances a piece covers, level after level, down to 1."""
    out = [-(-(length - GRAM + 1) // 2)]
    while out[-1] > 1:
        out.append(-(-out[-1] // 4))
    return out


def cut_segment(raw: bytes, gram: int, begin: int, windows: int, off: int, span: int, length: int) -> list[tuple]:
    """(gram, mark, begin, windows, off) of the segment's pieces."""
    import xxhash

    out = []
    anchor = begin + off
    for part in range((off - windows + 1) // span, off // span + 1):
        low = part * span  # distances from a window to the anchor: low to high
        high = min(low + span - 1, length - GRAM)
        skip = max(0, off - high)
        n = min(windows, off - low + 1) - skip
        core = raw[anchor - low : anchor - high + length]
        new = xxhash.xxh3_64_intdigest(b"%d %d %d " % (gram, span, part) + core)
        piece = raw[begin + skip : begin + skip + n + length - 1]
        mark = xxhash.xxh3_64_intdigest(piece, seed=off - skip)
        out.append((_signed(new), _signed(mark), begin + skip, n, off - skip))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pieces(rows: DataFrame, large: DataFrame, span: int, cfg: SuffixConfig) -> DataFrame:
    """Places of the pieces of the segments at the places ``large``."""
    own = large.groupBy("f", "r").agg(F.collect_list(F.struct("gram", "begin", "windows", "off")).alias("s"))
    both = packed(rows).join(own, ["f", "r"]).select("f", "r", "z", "s.gram", "s.begin", "s.windows", "s.off")
    names = ["f", "r", "gram", "mark", "begin", "windows", "off"]
    types = [pa.int64()] * 4 + [pa.int32()] * 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                f, r, z, *segment = (c[i].as_py() for c in b.columns)
                raw = _unpacked(z)
                cut = [(f, r, *x) for s in zip(*segment) for x in cut_segment(raw, *s, span, cfg.length)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cut), types)], names=names)

    return both.mapInArrow(run, f"{PLACE}, {SEGMENT}")


def met_again(every: DataFrame, total: int, cfg: SuffixConfig) -> tuple[DataFrame, DataFrame]:
    """The places whose gram occurs more than once, and the grams whose
    distinct segments hold more than ``shard_bytes``."""
    size = F.sum(F.col("windows") + F.lit(cfg.length - 1))
    grams = every.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), size.alias("size"))
    again = written(grams.where("n > 1"), "suffix-grams")
    met = join_split(every, again.drop("size"), "gram", "n", total).where("n > 1").drop("n")
    met = written(met, "suffix-met", compression="zstd")
    large = again.where(F.col("size") > cfg.shard_bytes).select("gram")
    if large.isEmpty():
        return met, large
    some = met.join(F.broadcast(large), "gram", "left_semi").groupBy("gram", "mark").agg(F.first("windows").alias("windows"))
    large = some.groupBy("gram").agg(size.alias("size")).where(F.col("size") > cfg.shard_bytes)
    return met, written(large.select("gram"), "suffix-large")


def met_places(rows: DataFrame, cfg: SuffixConfig) -> tuple[DataFrame, int]:
    """The places of segments (or pieces) that have a partner, in classes of
    at most ``shard_bytes`` of distinct text, and the number of segments."""
    every = written(segments(rows, cfg), "suffix-segments", compression="zstd")
    total = max(1, every.count())
    met, large = met_again(every, total, cfg)
    discard(every)
    for span in spans(cfg.length):
        if large.isEmpty():
            break
        small = met.join(F.broadcast(large), "gram", "left_anti")
        cut = pieces(rows, met.join(F.broadcast(large), "gram", "left_semi"), span, cfg)
        cut = written(cut, "suffix-pieces", compression="zstd")
        cut, large = met_again(cut, max(1, cut.count()), cfg)
        met = small.unionByName(cut)
    return met, total


def repeats(rows: DataFrame, cfg: SuffixConfig) -> DataFrame:
    """(f, r, lo, hi): runs of repeated window starts in every row."""
    met, total = met_places(rows, cfg)
    first = F.min(F.struct("f", "r", "begin", "off", "windows")).alias("one")
    distinct = met.groupBy("gram", "mark").agg(F.count(F.lit(1)).alias("copies"), first)
    distinct = distinct.select("gram", "mark", "copies", "one.*")
    found = written(sorted_shards(segment_texts(rows, distinct, cfg), cfg), "suffix-found")
    runs = found.groupBy("gram", "mark").agg(
        F.max("copies").alias("copies"), F.collect_list(F.struct("lo", "hi")).alias("runs")
    )
    runs = runs.withColumn("id", F.struct("gram", "mark")).drop("gram", "mark")
    places = met.select("f", "r", "begin", F.struct("gram", "mark").alias("id"))
    hit = join_split(places, runs, "id", "copies", total).where("runs is not null")
    each = hit.select("f", "r", "begin", F.explode("runs").alias("x"))
    return each.select("f", "r", (F.col("begin") + F.col("x.lo")).alias("lo"), (F.col("begin") + F.col("x.hi")).alias("hi"))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def without_repeats(docs: DataFrame, cfg: SuffixConfig = SuffixConfig(), with_bytes: bool = False) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 (and ``kept``, the remaining bytes)."""
    rows = placed(docs)
    spans = repeats(rows, cfg).groupBy("f", "r").agg(F.collect_list(F.struct("lo", "hi")).alias("s"))
    both = packed(rows).join(spans, ["f", "r"], "left").select("doc_id", "z", "s.lo", "s.hi")
    schema = RESULT + (", kept binary" if with_bytes else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i in range(b.num_rows):
                raw = _unpacked(b.column(1)[i].as_py())
                lo = b.column(2)[i].as_py()
                kept, spans = raw, 0
                if lo:
                    edge = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(edge, np.array(lo), 1)
                    np.add.at(edge, np.array(b.column(3)[i].as_py()) + cfg.length - 1, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    spans = len(_runs(gone)[0])
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
            cols = list(zip(*out)) or [()] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            n = len(names) if with_bytes else len(names) - 1
            yield pa.RecordBatch.from_arrays(arrays[:n], names=names[:n])

    return both.mapInArrow(run, schema)
