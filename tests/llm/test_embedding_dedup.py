import random
from collections import Counter

import numpy as np
import pytest

from vantage.llm import embedding_dedup as E


def frame(spark, data, kind="array<float>"):
    return spark.createDataFrame(data, f"vec_id long, embedding {kind}, label int")


def brute(data, threshold=0.95):
    """(vec_id, n_links, component_id, kept) of each row, by all pairs."""
    x = []
    for _, v, _ in data:
        v = None if v is None or not len(v) or any(c is None or not np.isfinite(c) for c in v) else np.array(v, np.float64)
        x.append(None if v is None or not v.any() else v / np.linalg.norm(v / np.abs(v).max()) / np.abs(v).max())
    near = [[] for _ in data]
    for i in range(len(data)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]) and float(x[i] @ x[j]) >= threshold:
                near[i].append(j)
                near[j].append(i)
    out = []
    for i, (vid, _, _) in enumerate(data):
        seen, todo = {i}, [i]
        while todo:
            todo += [k for k in near[todo.pop()] if k not in seen and not seen.add(k)]
        ids = [data[k][0] for k in seen if data[k][0] is not None]
        comp = min(ids) if ids else None
        out.append((vid, len(near[i]), comp, vid == comp))
    return Counter(out)


def got(df):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def f32(x):
    return np.asarray(x, np.float32).tolist()


def mixture(seed, n, d=24, groups=6):
    """Random directions, groups of noisy copies of several widths, exact and
    scaled copies, chains of neighbours just within the threshold."""
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=d) for _ in range(n)]
    for g in range(groups):
        c = rng.normal(size=d)
        c /= np.linalg.norm(c)
        out += [c + rng.normal(size=d) * (0.01, 0.05, 0.3)[g % 3] / np.sqrt(d) for _ in range(n // 4)]
    out += [out[3]] * 5 + [out[4] * 2.0] * 3
    a, b = np.linalg.qr(rng.normal(size=(d, 2)))[0].T
    out += [np.cos(k * 0.3) * a + np.sin(k * 0.3) * b for k in range(8)]
    order = rng.permutation(len(out))
    return [(int(i), f32(out[i]), int(i % 3)) for i in order]


SMALL = E.EmbeddingDedupConfig(block_rows=20, strip=8, lead=4, box_dims=4, sample_rows=150)


@pytest.mark.parametrize("cfg", [E.EmbeddingDedupConfig(), SMALL], ids=["one tile", "many tiles"])
def test_equals_brute_force(spark, cfg):
    data = mixture(1, 60)
    wide = frame(spark, data).selectExpr("*", "'x' as unit", "0 as dim", "1 as copies", "2 as cid", "3 as leaf", "4 as key")
    assert got(E.near_duplicates(wide, cfg)) == brute(data)


def test_awkward_rows(spark):
    rng = random.Random(3)
    v = [rng.gauss(0, 1) for _ in range(6)]
    data = [
        (1, None, 1), (2, [], 1), (3, [0.0] * 6, 1), (4, [None] + v[1:], 1), (5, [float("nan")] + v[1:], 1),
        (6, [float("inf")] + v[1:], 1), (7, v, None), (7, v, 1), (None, v, 1), (None, [-x for x in v], 1),
        (8, v[:5], 1), (9, [x * 1e300 for x in v], 1), (10, [x * 1e-300 for x in v], 1), (11, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0], 1), (12, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0], 1),
    ]
    for cfg in (E.EmbeddingDedupConfig(), E.EmbeddingDedupConfig(block_rows=2, strip=1, lead=1, sample_rows=4)):
        assert got(E.near_duplicates(frame(spark, data, "array<double>"), cfg)) == brute(data)


def test_nothing_usable(spark):
    assert E.near_duplicates(frame(spark, [])).count() == 0
    assert got(E.near_duplicates(frame(spark, [(1, None, 1), (None, None, None)]))) == brute([(1, None, 1), (None, None, 1)])


def test_threshold_is_inclusive_and_exact():
    """Cosines next to the threshold are decided like a product of the unit vectors."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 16))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    x[20:] = x[:20] * 0.95 + np.sqrt(1 - 0.95**2) * _across(x[:20], rng)
    cfg = E.EmbeddingDedupConfig(lead=4, strip=7)
    turn = np.linalg.qr(rng.normal(size=(16, 16)))[0]
    found = {(int(a), int(b)) for i, j in E.linked_pairs(x, x, turn, True, cfg) for a, b in zip(i, j)}
    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if float(np.einsum("i,i->", x[i], x[j])) >= 0.95}
    assert found == want


def _across(x, rng):
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(axis=1)[:, None] * x
    return y / np.sqrt((y * y).sum(axis=1))[:, None]


def test_tight_group_is_counted_without_comparison(spark):
    """Tiles of one tight group all link: no pair of them is compared."""
    rng = np.random.default_rng(7)
    c = rng.normal(size=16)
    group = [(i, f32(c + rng.normal(size=16) * 0.01), 0) for i in range(200)]
    loose = [(1000 + i, f32(rng.normal(size=16)), 0) for i in range(100)]
    data = group + loose
    cfg = E.EmbeddingDedupConfig(block_rows=16, sample_rows=1000, box_dims=8)
    assert got(E.near_duplicates(frame(spark, data), cfg)) == brute(data)
    rows = E.unit_rows(frame(spark, group)).selectExpr("unit", "dim", "vec_id as cid", "1L as copies", "key")
    trees = E.forest(rows, {16: 200}, {}, cfg)
    t = E.tiles(E.placed(rows, trees, {}, {}, 8), {}, 8)
    dim_of = {int(k): 16 for k in trees[16].left[trees[16].axis < 0]}
    routes = E.routes(t, dim_of, 0.95).collect()
    assert len(routes) > 10 and all(r["every"] for r in routes)


def test_far_tiles_are_left_out(spark):
    rng = np.random.default_rng(8)
    data = []
    for g in range(8):
        c = rng.normal(size=16) * 3
        data += [(100 * g + i, f32(c + rng.normal(size=16) * 0.02), 0) for i in range(20)]
    cfg = E.EmbeddingDedupConfig(block_rows=20, sample_rows=1000, box_dims=8)
    rows = E.unit_rows(frame(spark, data)).selectExpr("unit", "dim", "vec_id as cid", "1L as copies", "key")
    trees = E.forest(rows, {16: 160}, {}, cfg)
    t = E.tiles(E.placed(rows, trees, {}, {}, 8), {}, 8)
    dim_of = {int(k): 16 for k in trees[16].left[trees[16].axis < 0]}
    n = t.count()
    assert E.routes(t, dim_of, 0.95).count() < n * (n + 1) / 4
    assert got(E.near_duplicates(frame(spark, data), cfg)) == brute(data)


@pytest.mark.parametrize("sample_rows", [1, 40])
def test_lengths_that_the_sample_misses(spark, sample_rows):
    """Rare lengths beside a frequent one: the cuts are placed without them."""
    rng = np.random.default_rng(12)
    rare = [f32(rng.normal(size=d)) for d in (1, 2, 5, 7, 30)]
    data = mixture(8, 60, groups=2)
    data += [(1000 + i, [k * x for x in v], 0) for i, v in enumerate(rare) for k in (1, 2)]
    cfg = E.EmbeddingDedupConfig(block_rows=16, sample_rows=sample_rows, box_dims=3)
    assert got(E.near_duplicates(frame(spark, data), cfg)) == brute(data)
