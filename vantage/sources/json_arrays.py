"""Elements of the top-level arrays of large JSON documents, read in parallel.

A document such as ``{"images": [{...}, ...], "annotations": [...]}`` is one
JSON value, which Spark's JSON reader gives to one task. Here the text reader
cuts it at every "}", which splits a file like lines do, and three small steps
put the structure back together:

1. ``scan``: each file split counts its quotes and, for both cases (it begins
   inside a string or not), how the bracket depth changes. One row a split; the
   driver adds these up, so that every split's state at its begin is known.
2. ``pieces``: each split cuts out the elements at depth two of the runs
   (arrays) it sees. An element that crosses a border leaves its parts. What
   lies outside the elements becomes an outline, in which a row of elements is
   one empty object; the driver parses the joined outline, which checks the
   document around its elements.
3. ``elements``: runs get their section and the number of elements before them,
   crossing elements are joined by their first split.

The text of an element is parsed later, once, by ``from_json``. The driver
holds a few numbers and a short outline for each split, never elements.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.operators.checks import CheckFailed
from vantage.operators.util import broadcast_if_small

BLOCK = 4 << 20  # bytes of text handled at a time
PIECE = "file string, start long, run int, name string, n long, begins boolean, ends boolean, text string"
TYPES = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
NAMES = [c.split(" ")[0] for c in PIECE.split(", ")]
ELEMENT = b"\x01"  # stands for an element; JSON text holds no such byte
ROW = re.compile(rb"\x01(?:[ \t\r\n]*,[ \t\r\n]*\x01)+")
KEY = re.compile(rb'"((?:[^"\\]|\\.)*)"[ \t\r\n]*:[ \t\r\n]*$')


class BrokenDocument(CheckFailed):
    pass


def bare_path(path: Column) -> Column:
    return F.regexp_replace(path, "^[a-z0-9]+:/*", "/")


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """The text between closing braces, with its file and the split it begins in."""
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), "value")


def split_runs(b: pa.RecordBatch) -> Iterator[tuple[tuple[str, int, int], pa.Array]]:
    """((file, start, size), fragments) for each run of a batch's rows in one split."""
    file, start, size, value = b.columns
    value.validate(full=True)  # text that isn't UTF-8 is an error
    n = len(b)
    change = pc.or_(pc.not_equal(file.slice(1), file.slice(0, n - 1)), pc.not_equal(start.slice(1), start.slice(0, n - 1)))
    cuts = (np.flatnonzero(change.to_numpy(zero_copy_only=False)) + 1).tolist()
    for i, j in zip([0, *cuts], [*cuts, n]):
        yield (file[i].as_py(), start[i].as_py(), size[i].as_py()), value.slice(i, j - i).cast(pa.binary())


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(file, start, size, fragments, text) in runs of about BLOCK bytes of one
    split; every fragment gets its brace back."""
    at, held, rows, n = None, [], 0, 0
    for b in batches:
        for here, values in split_runs(b) if len(b) else ():
            if at != here or n >= BLOCK:
                if held:
                    yield *at, rows, b"}".join(held) + b"}"
                at, held, rows, n = here, [], 0, 0
            one = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            held.append(pc.binary_join(one, b"}")[0].as_py())
            rows, n = rows + len(values), n + len(held[-1])
    if held:
        yield *at, rows, b"}".join(held) + b"}"


def marks(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, quotes counted up to and with each byte, bracket steps)."""
    a = np.frombuffer(text, np.uint8)
    quote = a == 34
    if b"\\" in text:
        slash = a == 92
        before = np.maximum.accumulate(np.where(slash, -1, np.arange(len(a))))  # the last byte that is no backslash
        run = np.arange(len(a)) - 1 - np.concatenate([[-1], before[:-1]])  # backslashes right before each byte
        quote &= run % 2 == 0
    step = np.zeros(len(a), np.int32)
    step[(a == 123) | (a == 91)] = 1
    step[(a == 125) | (a == 93)] = -1
    return a, np.cumsum(quote, dtype=np.int32), step


def scan(rows: DataFrame) -> list:
    """A row for each split: file, start, size, bytes, quotes, and the change
    of depth when it begins outside (even) or inside (odd) a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, start, size, n, text in blocks(batches):
            _, quotes, step = marks(text)
            odd = quotes % 2 == 1
            depth = [int(step[~odd].sum()), int(step[odd].sum())]
            cols = [[file], [start], [size], [len(text)], [int(quotes[-1])], [depth[0]], [depth[1]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["file", "start", "size", "bytes", "quotes", "even", "odd"])

    # Blocks of a split follow each other in their task, so their order is kept by ``k``.
    found = rows.mapInArrow(run, "file string, start long, size long, bytes long, quotes long, even long, odd long")
    numbered = found.withColumn("k", F.monotonically_increasing_id())
    parts = F.sort_array(F.collect_list(F.struct("k", "bytes", "quotes", "even", "odd"))).alias("parts")
    return numbered.groupBy("file", "start", "size").agg(parts).orderBy("file", "start").collect()


# Files that Spark unpacks: their size says nothing about the text's.
PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate", ".xz")


def states(scanned: list) -> tuple[dict[tuple[str, int], tuple[int, int]], dict[str, bool | None]]:
    """{(file, start): (inside a string, depth)} at the begin of each split,
    and for each file whether its last fragment lacks a brace of its own (None:
    not known, for a packed file)."""
    out, bare, length = {}, {}, {}
    string = depth = 0
    last = None
    for r in scanned:
        if r.file != last:
            string = depth = 0
            last = r.file
        out[r.file, r.start] = (string, depth)
        for p in r.parts:
            depth += p.odd if string else p.even
            string = (string + p.quotes) % 2
            length[r.file, r.size] = length.get((r.file, r.size), 0) + p.bytes
    for (file, size), n in length.items():
        packed = file.lower().endswith(PACKED)
        if not packed and n not in (size + 1, size, size - 2, size - 3):  # with a byte order mark, three less
            raise BrokenDocument(f"{file}: not UTF-8")
        bare[file] = None if packed else n in (size + 1, size - 2)
    return out, bare


class _Split:
    """What one file split has seen so far. Rows are tuples in PIECE's order."""

    def __init__(self, file: str, start: int, string: int, depth: int):
        self.at = (file, start)
        self.string, self.depth = string, depth
        self.run = self.n = 0
        self.open = depth >= 3  # inside an element
        self.begins = False  # whether the open element began in this split
        self.part: list[bytes] = []  # of the open element, from earlier blocks
        self.tail = b""  # the end of what came before, outside elements
        self.outline = b""

    def feed(self, text: bytes) -> tuple[list[tuple], list[pa.RecordBatch]]:
        """Rows for what begins or crosses borders, batches of the elements
        that lie whole in ``text``."""
        a, quotes, step = marks(text)
        step = np.where((quotes + self.string) % 2 == 0, step, 0)
        after = self.depth + np.cumsum(step)
        before = after - step
        opens = (step > 0) & (before == 2)
        skeleton = np.where(opens, ELEMENT[0], a).astype(np.uint8)
        self.outline += skeleton[opens | (before <= 2) & (after <= 2)].tobytes()
        if len(self.outline) > 1 << 16:
            self.outline = short(self.outline)
        # An element opens and closes in turn; an array opens between elements.
        begins, ends = np.flatnonzero(opens), np.flatnonzero((step < 0) & (after == 2)) + 1
        arrays = np.flatnonzero((step > 0) & (before == 1))
        rows, whole, plain = [], [], 0  # plain: where what is outside elements begins
        if self.open and len(ends):
            plain = int(ends[0])
            self.part.append(text[:plain])
            rows.append(self._piece(True))
            self.open, self.part, self.tail, ends = False, [], b"", ends[1:]
        elif self.open:
            self.part.append(text)
            begins = begins[:0]
        borders = [0, *np.searchsorted(begins, arrays).tolist(), len(begins)]
        for k, (lo, hi) in enumerate(zip(borders, borders[1:])):
            if k:  # an array opens, or an object
                i = int(arrays[k - 1])
                self.run, self.n = self.run + 1, 0
                key = KEY.search(self.tail + text[plain:i]) if text[i] == 91 else None
                rows.append((*self.at, self.run, key[1].decode("utf-8", "replace") if key else "", -2, True, True, ""))
            done = min(hi, len(ends))  # the last one may stay open
            if done > lo:
                whole.append(self._whole(a, begins[lo:done], ends[lo:done]))
                self.tail, plain = b"", int(ends[done - 1])
            if hi > done:
                self.open, self.begins = True, True
                self.part.append(text[int(begins[done]) :])
        if not self.open:
            self.tail = (self.tail + text[plain:])[-4096:]
        self.depth, self.string = int(after[-1]), (self.string + int(quotes[-1])) % 2
        return rows, whole

    def _whole(self, a: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        k, lengths = len(begins), ends - begins
        inside = np.zeros(len(a) + 1, np.int8)
        inside[begins] += 1
        inside[ends] -= 1
        body = a[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        text = pa.StringArray.from_buffers(k, pa.py_buffer(offsets), pa.py_buffer(body))
        n = pa.array(np.arange(self.n, self.n + k))
        self.n += k
        same = [pa.repeat(pa.scalar(v, t), k) for v, t in zip((*self.at, self.run), TYPES)]
        yes = pa.repeat(True, k)
        return pa.RecordBatch.from_arrays([*same, pa.nulls(k, pa.string()), n, yes, yes, text], names=NAMES)

    def _piece(self, ends: bool) -> tuple:
        body = b"".join(self.part).decode("utf-8", "surrogatepass")
        n = self.n if self.begins else -1
        self.n += self.begins
        return (*self.at, self.run, None, n, self.begins, ends, body)

    def finish(self) -> list[tuple]:
        rows = [self._piece(False)] if self.open else []
        return [*rows, (*self.at, -1, None, -2, True, True, short(self.outline).decode("utf-8", "surrogatepass"))]


def short(outline: bytes) -> bytes:
    """The outline with each row of elements as one element."""
    return ROW.sub(ELEMENT, outline)


def pieces(rows: DataFrame, begin: dict[tuple[str, int], tuple[int, int]]) -> DataFrame:
    """Elements and parts of elements. Run 0 is the array a split begins in,
    and each array it opens is a further run (a row with n -2 has its name);
    ``n`` counts elements inside a run, a part without begin has -1. Run -1
    holds the outline."""

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), TYPES)], names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for file, start, _, _, text in blocks(batches):
            if split is None or split.at != (file, start):
                if split is not None:
                    yield batch(split.finish())
                split = _Split(file, start, *begin[file, start])
            found, whole = split.feed(text)
            if found:
                yield batch(found)
            yield from whole
        if split is not None:
            yield batch(split.finish())

    return rows.mapInArrow(run, PIECE)


def _without_last_brace(text: str) -> str:
    at = text.rindex("}")
    return text[:at] + text[at + 1 :]


def outlines(cut: DataFrame, bare: dict[str, bool | None], sections: dict[str, bool]) -> None:
    """Parses each document's outline: it must be one object, whose
    ``sections`` (name: required) are arrays of objects and stand once."""
    whole: dict[str, str] = {}
    for r in cut.where("run = -1").select("file", "start", "text").orderBy("file", "start").collect():  # a row a split
        whole[r.file] = whole.get(r.file, "") + r.text
    for file, text in whole.items():
        text = short(text.encode("utf-8", "surrogatepass")).replace(ELEMENT, b"{}").decode("utf-8", "surrogatepass")
        text = text.removeprefix("\ufeff")
        if bare[file]:
            text = _without_last_brace(text)
        try:
            pairs = json.loads(text, object_pairs_hook=list, strict=False)
        except ValueError as exc:
            try:
                pairs = json.loads(_without_last_brace(text), object_pairs_hook=list, strict=False) if bare[file] is None else None
            except ValueError:
                pairs = None
            if pairs is None:
                raise BrokenDocument(f"{file}: not a JSON document ({exc})") from None
        if not isinstance(pairs, list) or any(not isinstance(p, tuple) for p in pairs):
            raise BrokenDocument(f"{file}: not a JSON object")
        for name, required in sections.items():
            values = [v for k, v in pairs if k == name]
            if len(values) > 1:
                raise BrokenDocument(f"{file}: section {name} stands twice")
            if not values or values[0] is None:
                if required:
                    raise BrokenDocument(f"{file}: no section {name}")
            elif not isinstance(values[0], list) or any(v != [] for v in values[0]):
                raise BrokenDocument(f"{file}: section {name} is not an array of objects")


def run_places(cut: DataFrame) -> list[tuple]:
    """(file, start, run, section, place of its first element, and the
    (start, run, n) of the element that its part without begin belongs to).
    Places of the k-th document begin at k * 2**32."""
    facts = cut.where("run >= 0").groupBy("file", "start", "run").agg(
        F.max("name").alias("name"),
        F.count(F.when(F.col("begins") & (F.col("n") >= 0), 1)).alias("n"),
        F.max(F.when(F.col("begins") & ~F.col("ends"), F.col("n"))).alias("open"),
        F.max(F.when(~F.col("begins"), F.col("ends").cast("int"))).alias("rest"),
    )
    out, last, document = [], None, -1
    for r in facts.orderBy("file", "start", "run").collect():  # a few rows a split
        if r.file != last:
            document += 1
            section, base, owner, last = "", 0, (None, None, None), r.file
        if r.run > 0:
            section, base = r.name, document << 32
        out.append((r.file, r.start, r.run, section, base, *owner))
        base += r.n
        if r.rest:
            owner = (None, None, None)
        if r.open is not None:
            owner = (r.start, r.run, r.open)
    return out


def read_sections(spark: SparkSession, path: str, sections: dict[str, bool], keep) -> DataFrame:
    """The elements of the ``sections`` (name: required) of all documents at
    ``path``: file, section, pos (place in its array, documents in the order
    of their paths), text. ``keep(df, name)``
    writes a table once and reads it back."""
    rows = fragments(spark, path)
    scanned = scan(rows)
    if not scanned:
        raise BrokenDocument(f"{path}: no JSON document")
    begin, bare = states(scanned)
    cut = keep(pieces(rows, begin), "json-pieces")
    outlines(cut, bare, sections)
    place = spark.createDataFrame(
        run_places(cut), "file string, start long, run int, section string, base long, ostart long, orun int, on long")
    text = cut.where("run >= 0 and n > -2").join(broadcast_if_small(place), ["file", "start", "run"])
    wanted = list(sections)
    own = F.col("begins") & F.col("ends")
    whole = text.where(own & F.col("section").isin(wanted)).select("file", "section", (F.col("base") + F.col("n")).alias("pos"), "text")
    # An element across splits: its parts meet under the place of its begin.
    first = lambda o, c: F.when(F.col("begins"), F.col(c)).otherwise(F.col(o)).alias(c)
    parts = text.where(~own).select("file", first("ostart", "start"), first("orun", "run"), first("on", "n"), F.col("start").alias("at"), "text")
    joined = parts.groupBy("file", "start", "run", "n").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda p: p["text"]), "").alias("text"))
    joined = joined.join(broadcast_if_small(place), ["file", "start", "run"]).where(F.col("section").isin(wanted))
    return whole.unionByName(joined.select("file", "section", (F.col("base") + F.col("n")).alias("pos"), "text"))


def parsed(text: Column, schema) -> Column:
    """An element's text as a struct; one that doesn't parse fails the read."""
    bracket = F.when(text.startswith("{"), text).otherwise(F.raise_error(F.lit("an element is not an object")))
    return F.from_json(bracket, schema, {"mode": "FAILFAST"})
