"""Order-preserving packing by dynamic programming.

Documents become token ids (each closed by ``end_id``), and the stream of ids
is cut, in order, into sequences of at most ``length`` ids. Cuts are chosen by
dynamic programming over document ends (free), sentence ends, clause ends and,
in long stretches without one, fixed steps, minimising padding plus a penalty
for each cut inside a document. For a cut at position p the cost is

    min over cuts q in [p - length, p) of cost(q) + length - (p - q), + penalty(p)

a sliding minimum of cost(q) + q, kept by a monotone queue. Sequences whose
length is a power of two need no padding; those of half and a quarter length
are extra transitions, and the end of a shard may fall into such sequences.

Every input partition is a shard with its own sequences, so nothing is
shuffled. A shard streams: the program runs over some hundred thousand ids at
a time and carries its last sequences over, so memory is bounded by that and by
the longest document.

Defined results: a null or empty text is its end id alone; repeated rows and
ids are packed row by row; a document longer than a sequence is cut; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class PackConfig:
    """``tokenizer`` names a file of the public tokenizers. Penalties are in
    ids of padding. ``cache_words`` bounds the word cache of a process."""

    tokenizer: str = "word_bpe_49k.json"
    end_id: int = 1
    length: int = 2048
    sentence_penalty: float = 4.0
    clause_penalty: float = 8.0
    word_penalty: float = 32.0
    word_step: int = 64
    chunk_ids: int = 1 << 18
    cache_words: int = 1_000_000
    encode_bytes: int = 4 << 20


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)

# Signs the fast path takes off a word's end; a run of them is one unit of the
# tokenizer's own word rule.
TRAILING = ".,!?;:$#%&*|"
END = b"\xff"  # closes a text; no UTF-8 text holds this byte
SPACED_END = b" \xff "
LAST_PLAIN = "ÿ"  # up to here lower-casing and composition are one to one


class WordTokens:
    """Token ids of white-space separated words, through the tokenizer.

    The tokenizer drops white space and never joins across it, so a text's ids
    are its words' ids in a row, and each word is encoded once per process.
    """

    def __init__(self, name: str, most: int):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(public_tokenizers.path(name))
        vocab = self.encoder.get_vocab()
        size = max(vocab.values()) + 1
        self.closes = np.zeros(size, bool)  # token ends a word unit
        self.sentence = np.zeros(size, np.int8)  # token ends a sentence (2) or a clause (1)
        for token, i in vocab.items():
            if token.endswith("</w>"):
                self.closes[i] = True
                self.sentence[i] = 2 * bool(re.fullmatch(r"[.!?]+[\"')\]]*", token[:-4])) or token[:-4] in (",", ";", ":")
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.words = _Numbered()
        self.words[END] = 0
        self.units: dict[str | bytes, int] = {"": 0}
        # Per word its two units, per unit its place in flat.
        self.core, self.tail = [np.zeros(1, np.int32)], [np.zeros(1, np.int32)]
        self.flat: list[np.ndarray] = []
        self.count = [np.zeros(1, np.int32)]

    def _add_units(self, names: list, ids: np.ndarray, counts: np.ndarray) -> None:
        self.units.update(zip(names, range(len(self.units), len(self.units) + len(names))))
        self.flat.append(ids.astype(np.uint32))
        self.count.append(counts.astype(np.int32))

    def _learn(self) -> None:
        """Units of the words numbered since the last call."""
        new, self.words.new = self.words.new, []
        texts = b"\n".join(new).decode("utf-8", "replace").split("\n")
        cores = [t.rstrip(TRAILING) for t in texts]
        plain = [(c.isalpha() or not c) and max(t) <= LAST_PLAIN for t, c in zip(texts, cores)]
        pairs = [(c.lower(), t[len(c) :]) if p else (w, "") for w, t, c, p in zip(new, texts, cores, plain)]
        units = self.units
        fresh = [u for u in dict.fromkeys(u for pair in pairs for u in pair) if u not in units]
        easy = [u for u in fresh if isinstance(u, str)]
        for k in range(0, len(easy), 2000):
            part = easy[k : k + 2000]
            ids = np.array(self.encoder.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids)
            stops = np.flatnonzero(self.closes[ids]) + 1
            if len(stops) == len(part):
                self._add_units(part, ids, np.diff(np.concatenate([[0], stops])))
            else:
                self._one_by_one(part, part)
        hard = [u for u in fresh if isinstance(u, bytes)]
        self._one_by_one(hard, [u.decode("utf-8", "replace") for u in hard])
        self.core.append(np.fromiter((units[a] for a, _ in pairs), np.int32, len(pairs)))
        self.tail.append(np.fromiter((units[b] for _, b in pairs), np.int32, len(pairs)))

    def _one_by_one(self, names: list, texts: list[str]) -> None:
        found = [e.ids for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.array([i for x in found for i in x], np.uint32)
        self._add_units(names, ids, np.array([len(x) for x in found], np.int32))

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, each text closed by end_id; number of ids per text)."""
        if len(self.words) > self.most:
            self.clear()
        words = (SPACED_END.join(texts) + SPACED_END).split()
        gc.disable()  # nothing here is cyclic, and a collection walks the whole cache
        at = np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))
        if self.words.new:
            self._learn()
        gc.enable()
        for parts in (self.core, self.tail, self.flat, self.count):
            if len(parts) > 1:
                parts[:] = [np.concatenate(parts)]
        flat = self.flat[0] if self.flat else np.zeros(0, np.uint32)
        place = np.cumsum(self.count[0]) - self.count[0]
        unit = np.empty(2 * len(at), np.int32)
        unit[0::2], unit[1::2] = self.core[0][at], self.tail[0][at]
        closing = at == 0
        count = self.count[0][unit]
        count[0::2][closing] = 1
        ends = np.cumsum(count, dtype=np.int64)
        source = np.repeat(place[unit] - (ends - count), count) + np.arange(ends[-1])
        last = ends[0::2][closing] - 1
        source[last] = 0
        ids = flat[source] if len(flat) else np.zeros(len(source), np.uint32)
        ids[last] = end_id
        return ids, np.diff(np.concatenate([[0], last + 1]))


class _Numbered(dict):
    """Numbers unknown words in the order they come and lists them in ``new``."""

    def __init__(self) -> None:
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def _tokens(cfg: PackConfig) -> WordTokens:
    """One per Python worker process, so that its cache outlives a task."""
    import os
    import sys
    import types

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    home = sys.modules.setdefault("_vantage_word_tokens", types.ModuleType("_vantage_word_tokens"))
    key = f"{cfg.tokenizer}:{cfg.cache_words}"
    if key not in home.__dict__:
        home.__dict__[key] = WordTokens(cfg.tokenizer, cfg.cache_words)
    return home.__dict__[key]


def candidates(ids: np.ndarray, ends: np.ndarray, sentence: np.ndarray, cfg: PackConfig) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions (0 first, the last id's end last) with their penalties."""
    n = len(ids)
    penalty = np.full(n + 1, -1.0)
    kind = sentence[np.minimum(ids, len(sentence) - 1)]
    penalty[1:][kind == 2] = cfg.sentence_penalty
    penalty[1:][kind == 1] = cfg.clause_penalty
    penalty[ends] = 0.0
    penalty[0] = 0.0
    at = np.flatnonzero(penalty >= 0)
    gap = np.diff(at)
    for k in np.flatnonzero(gap > 4 * cfg.word_step):
        penalty[at[k] + cfg.word_step : at[k + 1] : cfg.word_step] = cfg.word_penalty
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def cuts(at: np.ndarray, penalty: np.ndarray, cfg: PackConfig) -> list[int]:
    """The cut positions of least cost, from at[0] to at[-1]."""
    n, length = len(at), cfg.length
    pos, pen = at.tolist(), penalty.tolist()
    short = []  # exact matches of the shorter full sequences
    for size in (length // 2, length // 4):
        k = np.searchsorted(at, at - size)
        short.append(np.where((at >= size) & (at[np.minimum(k, n - 1)] == at - size), k, -1).tolist())
    half, quarter = short
    cost, back = [0.0] * n, [-1] * n
    value = [0.0] * n  # cost + position
    value[0] = float(pos[0])
    queue = deque([0])
    for j in range(1, n):
        p = pos[j]
        low = p - length
        while pos[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        c = value[i] + length - p
        h = half[j]
        if h >= 0 and cost[h] + 1 < c:
            c, i = cost[h] + 1, h
        h = quarter[j]
        if h >= 0 and cost[h] + 2 < c:
            c, i = cost[h] + 2, h
        c += pen[j]
        cost[j], back[j] = c, i
        v = c + p
        value[j] = v
        while queue and value[queue[-1]] > v:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j > 0:
        out.append(pos[j])
        j = back[j]
    return out[::-1]


def tail_cuts(begin: int, end: int, cfg: PackConfig) -> list[int]:
    """Cuts of a shard's last, unfilled sequence: into lengths that are powers
    of two where that costs less than padding it."""
    n = end - begin
    bits = [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]
    if cfg.length - n <= cfg.word_penalty * (len(bits) - 1):
        return [end]
    return (begin + np.cumsum(bits)).tolist()


def pack(docs: DataFrame, cfg: PackConfig = PackConfig(), with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids, the piece's token ids)."""
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = _tokens(cfg)
        sequence = TaskContext.get().partitionId() << 40
        # What is not written yet: ids, and per document its key, its number of
        # ids, and where it starts in ids (negative: before what is held).
        ids = np.zeros(0, np.uint32)
        keys: list = []
        counts: list[int] = []
        begins: list[int] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, sequence
            n = len(ids)
            if not n:
                return
            first, size = np.array(begins), np.array(counts)
            ends = first + size
            at, penalty = candidates(ids, ends, tokens.sentence, cfg)
            chosen = cuts(at, penalty, cfg)
            if last:
                before = chosen[-2] if len(chosen) > 1 else 0
                chosen[-1:] = tail_cuts(before, n, cfg)
            else:
                chosen = [c for c in chosen if c <= n - 2 * cfg.length] or chosen[:1]
            done = chosen[-1]
            stops = np.unique(np.concatenate([np.array(chosen), ends[ends <= done]]))
            starts = np.concatenate([[0], stops[:-1]])
            doc = np.searchsorted(ends, starts, "right")
            which = np.searchsorted(chosen, starts, "right")
            seq_start = np.concatenate([[0], np.array(chosen)])[which]
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
            cols = [
                pa.array([keys[d] for d in doc.tolist()], pa.int64()), pa.array(starts - first[doc]), pa.array(stops - starts),
                pa.array(crc, pa.int64()), pa.array(size[doc]), pa.array(which + sequence), pa.array(starts - seq_start),
            ]
            if with_ids:
                offsets = pa.array(np.concatenate([[0], stops]), pa.int32())
                cols.append(pa.ListArray.from_arrays(offsets, pa.array(ids[:done].astype(np.int32))))
            yield pa.RecordBatch.from_arrays(cols, names=[c.split(" ")[0] for c in schema.split(", ")])
            sequence += len(chosen)
            live = int(np.searchsorted(ends, done, "right"))
            ids = ids[done:]
            del keys[:live], counts[:live]
            begins[:] = (first[live:] - done).tolist()

        for b in batches:
            held: list[bytes] = []
            held_keys: list = []
            size = 0
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                held_keys.append(key)
                held.append((text.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(held[-1])
                if size < cfg.encode_bytes:
                    continue
                ids = _append(ids, keys, counts, begins, held_keys, tokens.encode(held, cfg.end_id))
                held, held_keys, size = [], [], 0
                if len(ids) >= cfg.chunk_ids:
                    yield from flush(False)
            if held:
                ids = _append(ids, keys, counts, begins, held_keys, tokens.encode(held, cfg.end_id))
        yield from flush(True)

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return rows.mapInArrow(run, schema)


def _append(ids, keys, counts, begins, new_keys, encoded) -> np.ndarray:
    new, sizes = encoded
    starts = len(ids) + np.cumsum(sizes) - sizes
    keys += new_keys
    counts += sizes.tolist()
    begins += starts.tolist()
    return np.concatenate([ids, new])
