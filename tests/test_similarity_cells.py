"""Exact joins over cells: any block size gives the brute-force answer."""

import numpy as np
import pytest

from vantage.operators import similarity as S


def vectors(spark, x, ids=None, names="viewpoint_id long, centroid array<double>"):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids, x)], names)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def clustered(seed, n, d, spread=0.08, groups=10):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(groups, d))[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, d))


def brute_neighbours(left, right, right_ids, k, threshold):
    s = unit(left) @ unit(right).T
    out = []
    for row in s:
        best = sorted(zip(-row, right_ids))[:k]
        out.append([(int(i), rank) for rank, (v, i) in enumerate(best, 1) if threshold is None or -v >= threshold])
    return out


LEFT = "seq long, embedding array<double>"


@pytest.mark.parametrize("kind", ["random", "clustered", "ties"])
@pytest.mark.parametrize("block_rows", [4, 16, 1000])
@pytest.mark.parametrize("k,threshold", [(1, None), (3, 0.2)])
def test_neighbours_are_the_same_at_any_registry_size(spark, kind, block_rows, k, threshold):
    rng = np.random.default_rng(3)
    if kind == "random":
        left, right = rng.normal(size=(60, 5)), rng.normal(size=(70, 5))
    elif kind == "clustered":
        left, right = clustered(4, 60, 6), clustered(4, 70, 6)
    else:  # few directions, many equal scores
        eye = np.eye(4)
        left, right = eye[rng.integers(0, 4, 60)], eye[rng.integers(0, 4, 70)] * rng.integers(1, 3, (70, 1)) * 2.0
    ids = rng.permutation(500)[:70]
    lid = rng.integers(0, 20, 60)  # repeated left ids
    got = S.nearest_neighbours(vectors(spark, left, lid, LEFT), vectors(spark, right, ids), k=k, threshold=threshold, block_rows=block_rows)
    want = sorted((int(i), r, rank) for i, found in zip(lid, brute_neighbours(left, right, ids, k, threshold)) for r, rank in found)
    assert sorted((r.left_id, r.right_id, r["rank"]) for r in got.collect()) == want


def test_empty_sides(spark):
    x = vectors(spark, np.eye(3))
    none = vectors(spark, [])
    assert S.nearest_neighbours(vectors(spark, np.eye(3), None, LEFT), none).count() == 0
    assert S.nearest_neighbours(vectors(spark, [], None, LEFT), x, block_rows=1).count() == 0
    assert S.similar_pairs(none, 0.5).count() == 0
    with pytest.raises(Exception, match="no direction"):
        S.similar_pairs(vectors(spark, [[0.0, 0.0], [1.0, 0.0]]), 0.5).collect()


def test_far_cells_are_not_searched(spark, monkeypatch):
    """On clustered data the second round asks for few cells."""
    asked = []
    plain = S._kept
    monkeypatch.setattr(S, "_kept", lambda df, name: asked.append((name, out := plain(df, name))) or out)
    left, right = clustered(5, 300, 16, 0.02, 12), clustered(5, 400, 16, 0.02, 12)
    S.nearest_neighbours(vectors(spark, left, None, LEFT), vectors(spark, right), block_rows=20).count()
    more = next(df for name, df in asked if name == "nn-more")
    cells = next(df for name, df in asked if name == "nn-right").select("cell").distinct().count()
    assert more.count() < 300 * (cells - 1) / 3


@pytest.mark.parametrize("threshold", [1.0, 0.999999, 0.97, 0.4])
@pytest.mark.parametrize("pivots", [0, 3, 16])
def test_pairs_at_any_threshold(spark, threshold, pivots):
    """At 1.0 only copies pair; exact copies of one vector can't be split."""
    x = np.concatenate([np.eye(6)[[0, 0, 0, 1, 1, 2]], np.eye(6)[np.arange(40) % 6], clustered(6, 60, 6)])
    s = unit(x) @ unit(x).T
    got = {(r.id_a, r.id_b) for r in S.similar_pairs(vectors(spark, x), threshold, block_rows=8, pivots=pivots).collect()}
    sure = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if s[i, j] >= threshold + 1e-12 or np.array_equal(x[i], x[j])}
    maybe = {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if s[i, j] >= threshold - 1e-12}
    assert sure <= got <= maybe


def test_a_dense_cell_is_split_again(spark):
    """A third of all vectors in one narrow cone, in small groups inside it."""
    rng = np.random.default_rng(9)
    cone = np.zeros(24)
    cone[0] = 3.0
    inside = cone + unit(rng.normal(size=(20, 24)))[rng.integers(0, 20, 300)] + 0.01 * rng.normal(size=(300, 24))
    x = np.concatenate([inside, clustered(10, 600, 24, 0.02, 30)])
    found = S.search_pairs(vectors(spark, x), 0.99, block_rows=25, pivots=8)
    s = unit(x) @ unit(x).T
    want = {(i, j) for i in range(900) for j in range(i + 1, 900) if s[i, j] >= 0.99}
    assert {(r.id_a, r.id_b) for r in found.pairs.collect()} == want
    assert found.compared(900) < 0.2 * 900 * 899 / 2
    dense = sum(1 for i, j in want if j < 300)
    assert dense > 0
