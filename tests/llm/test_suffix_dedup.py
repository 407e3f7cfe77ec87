import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm.data import as_set, rows, table, with_extra
from vantage.llm import suffix_dedup as S

COLS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(data, length=200):
    texts = [(r[1] or "").encode() for r in data]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(data, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((r[0], len(t), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def cases():
    """Passages in other surroundings, periodic texts, runs, copies."""
    rng = random.Random(9)
    data = [r for r in rows(4, 30) if not r[1] or len(r[1]) < 20_000]
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    text = lambda n: "".join(rng.choice("äbcdefgh \n") for _ in range(n))
    more = [text(50) + passage + text(70), passage + text(90), text(333) + passage[:199], passage[30:230] + text(9),
            "xyz" * 300, "q" * 450, "q" * 199, "q" * 200, text(40) + "xyz" * 80 + text(40), passage * 3]
    return data + [(1000 + i, t, "en", "s", len(t)) for i, t in enumerate(more)]


@pytest.mark.parametrize("cfg", [S.SuffixConfig(), S.SuffixConfig(block_bytes=1 << 12, scan_bytes=100)])
def test_equals_brute_force(spark, cfg):
    data = cases()
    assert as_set(S.without_repeats(with_extra(table(spark, data)), cfg), *COLS) == brute(data)


def test_classes_larger_than_memory_go_by_disk(spark):
    """Tiny bounds: every class spills its queue and keeps its marks on disk."""
    data = cases()[-16:]
    cfg = S.SuffixConfig(memory_bytes=1, queue_rows=3)
    assert as_set(S.without_repeats(table(spark, data), cfg), *COLS) == brute(data)


def test_spilled_class_keeps_prefixes_across_blocks(tmp_dir):
    """One class of many distinct segments with different begins and ends, its
    queue spilled: blocks of a scan border inside groups of equal suffixes."""
    rng = random.Random(3)
    for rows_held in (3, 7, 50):
        cfg = S.SuffixConfig(length=60, queue_rows=rows_held)
        sides = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(3)]
        raw, off, windows = [], [], []
        for _ in range(80):
            left, right = rng.choice(sides), rng.choice(sides)
            o = rng.randrange(0, 29)
            w = rng.randrange(1, o + 2)
            tail = bytearray(right[: w + 59 - o - 32])
            if tail and rng.random() < 0.5:
                tail[rng.randrange(len(tail))] = 99
            raw.append(left[60 - o :] + b"G" * 32 + bytes(tail))
            off.append(o)
            windows.append(w)
        held = [(k - o, t[k : k + 60]) for t, o, w in zip(raw, off, windows) for k in range(w)]
        seen = Counter(held)
        n = len(raw)
        args = np.zeros(n, np.int64), np.array(off), np.array(windows), np.ones(n, np.int64), np.frombuffer(b"".join(raw), np.uint8), cfg
        got = np.array(S.repeated_windows(*args, folder=tmp_dir))
        assert got.tolist() == [seen[x] > 1 for x in held] == S.repeated_windows(*args).tolist()
        assert 0 < got.sum() < len(got)


def largest_class(spark, data, cfg):
    met, _ = S.met_places(S.placed(table(spark, data)), cfg)
    distinct = met.groupBy("gram", "mark").agg({"windows": "first"}).withColumnRenamed("first(windows)", "w")
    return max(r[0] for r in distinct.groupBy("gram").agg({"w": "sum", "mark": "count"}).selectExpr(f"`sum(w)` + `count(mark)` * {cfg.length - 1}").collect())


def test_large_classes_are_cut_by_content(spark):
    """A line that every document holds, in surroundings of its own."""
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("äbcdefgh ") for _ in range(n))
    line = word(190)
    data = [(i, word(150) + line + word(150), "en", "s", 1) for i in range(60)]
    shared = word(40)
    data += [(100 + i, word(100) + shared + line + word(9) + "q" * 210, "en", "s", 1) for i in range(40)]
    data += [(200 + i, "pq" * 120 + line[: 150 + i], "en", "s", 1) for i in range(9)] + cases()[-10:]
    bound = 4_000
    assert largest_class(spark, data, S.SuffixConfig()) > 4 * bound
    for cfg in (S.SuffixConfig(shard_bytes=bound), S.SuffixConfig(shard_bytes=1)):
        assert largest_class(spark, data, cfg) <= max(cfg.shard_bytes, cfg.length)
        assert as_set(S.without_repeats(table(spark, data), cfg), *COLS) == brute(data)


def test_empty_table(spark):
    assert S.without_repeats(table(spark, [])).count() == 0


def test_kept_bytes(spark):
    data = [(1, "a" * 300 + "end", "e", "s", 1), (2, "other", "e", "s", 1)]
    got = {r.doc_id: bytes(r.kept) for r in S.without_repeats(table(spark, data), with_bytes=True).collect()}
    assert got == {1: b"end", 2: b"other"}


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(5)
    for alphabet in (2, 20):
        text = rng.integers(97, 97 + alphabet, 900).astype(np.uint8)
        both = np.concatenate([rng.integers(97, 100, 57).astype(np.uint8), text])
        a = S.anchors(S.gram_hashes(text), 200)
        b = S.anchors(S.gram_hashes(both), 200)
        n = len(text) - 199
        assert (a[:n] + 57 == b[57 : 57 + n]).all()
        assert ((a[:n] >= np.arange(n)) & (a[:n] <= np.arange(n) + 168)).all()


def test_runs_in_steps():
    rng = np.random.default_rng(1)
    marks = rng.random(1000) < 0.6
    for step in (1, 7, 1000, 5000):
        lo, hi = S._runs(marks, step)
        back = np.zeros(1000, bool)
        for a, b in zip(lo, hi):
            assert a < b and not back[a:b].any()
            back[a:b] = True
        assert (back == marks).all()
    assert [len(x) for x in S._runs(np.zeros(0, bool))] == [0, 0]


@pytest.mark.parametrize("memory", [1, 100, 1 << 30])
@pytest.mark.parametrize("rows_a_batch", [1, 3, 1000])
def test_blocks_keep_classes_whole(spark, memory, rows_a_batch):
    """However the batches fall, the text goes to memory or to a file, and a
    block ends at a class's end only."""
    data = cases()[-14:]
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_a_batch))
    try:
        cfg = S.SuffixConfig(memory_bytes=memory, block_bytes=2000, queue_rows=1000)
        assert as_set(S.without_repeats(table(spark, data), cfg), *COLS) == brute(data)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
