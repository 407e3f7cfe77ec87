import random
import re

import numpy as np
import pytest
import xxhash

from llm.data import WORD, as_set, rows, table, with_extra
from vantage.llm import simhash as S


def brute_fp(text, k=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    hs = [xxhash.xxh64(" ".join(w[i : i + k]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bound=3):
    """Smallest index reachable from each."""
    n, root = len(fps), list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bound:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_equals_brute_force(spark):
    data = [r for r in rows() if r[0] is not None]
    data = list({r[0]: r for r in data}.values())
    data.sort(key=lambda r: r[0])
    fps = [brute_fp(r[1]) for r in data]
    comp = brute_components(fps)
    want = sorted([(r[0], f"{f:016x}", data[c][0]) for r, f, c in zip(data, fps, comp)], key=repr)
    got = as_set(S.near_duplicates(with_extra(table(spark, data))), "doc_id", "fingerprint", "component_id")
    assert got == want


def test_null_and_repeated_ids(spark):
    data = [(None, "a b c d", "e", "s", 1), (4, "a b c d", "e", "s", 1), (4, "a b c d", "e", "s", 1), (None, "other words here now", "e", "s", 1)]
    got = as_set(S.near_duplicates(table(spark, data)), "doc_id", "component_id")
    assert got == [(4, 4), (4, 4), (None, 4), (None, None)]


def test_empty_table(spark):
    assert S.near_duplicates(table(spark, [])).count() == 0


def _linked(spark, fps, parts, cfg):
    x = spark.createDataFrame([(int(np.int64(np.uint64(f))),) for f in fps], "x long")
    return {tuple(r) for r in S.connected_components(S.links(x, parts, cfg)).collect()}


@pytest.mark.parametrize("parts", [
    [(0, 32, 1), (32, 32, 1)], [(0, 16, 0), (16, 16, 0), (32, 16, 0), (48, 16, 0)], [(0, 16, 1), (16, 48, 1)], [(0, 16, 0), (16, 16, 0), (32, 32, 1)],
])
@pytest.mark.parametrize("split", [4096, 3])
def test_links_of_random_flips(spark, parts, split):
    """Chains and balls of fingerprints, whatever the partitions and splits."""
    rng = random.Random(7)
    fps = set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            for _ in range(rng.randint(1, 5)):
                f ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    comp = brute_components(fps)
    cfg = S.SimHashConfig(split_least=split, split_share=1e-9)
    got = dict(_linked(spark, fps, parts, cfg))
    signed = [int(np.int64(np.uint64(f))) for f in fps]
    groups = {}
    for f, c in zip(signed, comp):
        groups.setdefault(c, set()).add(f)
    want = {frozenset(g) for g in groups.values() if len(g) > 1}
    back = {}
    for node, root in got.items():
        back.setdefault(root, set()).add(node)
    assert {frozenset(g) for g in back.values()} == want


def test_partition_choice_meets_the_pigeonhole_condition():
    rng = np.random.default_rng(1)
    for skew in (1, 50):
        pairs = [S.block_distances(rng.integers(0, skew, 1 << 16).astype(float) + 1e-3, 3) for _ in range(4)]
        parts = S.choose_partitions(pairs, 1000, S.SimHashConfig())
        assert sum(t + 1 for _, _, t in parts) == 4
        assert all(0 <= lo and lo + w <= 64 for lo, w, _ in parts)


def test_block_distances():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 3, 1 << 6).astype(float)
    want = [sum(h[a] * h[b] for a in range(64) for b in range(64) if (a ^ b).bit_count() == d) for d in range(4)]
    assert np.allclose(S.block_distances(h, 3), want)


def test_one_per_group(spark):
    data = list({r[0]: r for r in rows() if r[0] is not None}.values())
    docs = table(spark, data)
    kept = {r.doc_id for r in S.one_per_group(docs).collect()}
    assert kept == {r.component_id for r in S.near_duplicates(docs).collect()}


def test_one_per_group_with_repeated_and_null_ids(spark):
    """A row that shares its id with a row of another group stays."""
    a, b, c = "one two three four five six", "seven eight nine ten eleven twelve", "red green blue white black grey"
    data = [(1, a, "e", "s", 1), (2, a, "e", "s", 2), (2, b, "e", "s", 3), (None, b, "e", "s", 4), (None, c, "e", "s", 5), (None, c, "e", "s", 6), (7, a, "e", "s", 7), (1, a, "e", "s", 8)]
    got = S.one_per_group(table(spark, data)).collect()
    assert sorted(r.text for r in got) == sorted([a, b, c])
    assert {r.doc_id for r in got} == {1, 2, None}


def test_hot_keys_are_split_below_the_bound(spark):
    """20,000 fingerprints under one block value, and the dense case where
    only 15 bits vary: every key ends below the bound."""
    rng = np.random.default_rng(5)
    cfg = S.SimHashConfig(split_share=1e-9)
    parts = [(0, 16, 0), (16, 16, 0), (32, 16, 0), (48, 16, 0)]
    for fps in (rng.integers(0, 1 << 48, 20_000, dtype=np.int64) << 16, rng.permutation(1 << 15)[:20_000].astype(np.int64) << 7):
        x = spark.createDataFrame([(int(f),) for f in np.unique(fps)], "x long")
        rows = S.split_hot(S.keys(x, parts), cfg)
        assert rows.groupBy("key").count().agg({"count": "max"}).first()[0] <= cfg.split_least


def test_split_keys_lose_no_link(spark):
    rng = random.Random(11)
    fps = sorted({(rng.getrandbits(12) << 20) | 5 for _ in range(300)})  # one hot block, 12 varying bits
    cfg = S.SimHashConfig(split_least=4, split_share=1e-9, max_bits=2)
    got = dict(_linked(spark, fps, [(0, 16, 0), (16, 16, 0), (32, 32, 0)], cfg))
    comp = brute_components(fps, 2)
    back = {}
    for node, root in got.items():
        back.setdefault(root, set()).add(node)
    want = {}
    for f, c in zip(fps, comp):
        want.setdefault(c, set()).add(f)
    assert {frozenset(g) for g in back.values()} == {frozenset(g) for g in want.values() if len(g) > 1}


@pytest.mark.parametrize("bits", [0, 1, 8, 12, 16])
def test_any_number_of_bits_has_a_plan(bits):
    rng = np.random.default_rng(bits)
    cfg = S.SimHashConfig(max_bits=bits)
    pairs = [S.block_distances(rng.integers(0, 3, 1 << 16).astype(float), bits) for _ in range(4)]
    parts = S.choose_partitions(pairs, 1000, cfg)
    assert sum(t + 1 for _, _, t in parts) == bits + 1
