import hashlib
from collections import Counter

import numpy as np
import pytest

from vantage.llm import vector_codes as V


def frame(spark, data, kind="array<double>"):
    return spark.createDataFrame(data, f"vec_id long, embedding {kind}, label int")


def usable(data, parts):
    ok = [r for r in data if r[1] is not None and len(r[1]) and len(r[1]) % parts == 0 and all(c is not None and np.isfinite(c) for c in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    return [r for r in ok if len(r[1]) == len(ok[0][1])]


def brute(data, parts=16, entries=64, rounds=2, scale=256):
    """The contract in plain Python integers."""
    rows = usable(data, parts)
    x = [[int(np.floor(scale * c)) for c in r[1]] for r in rows]
    if not x:
        return Counter()
    w = len(x[0]) // parts
    books = [[v[p * w : (p + 1) * w] for v in x[:entries]] for p in range(parts)]

    def best(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = [[] for _ in books[p]]
            for v in x:
                mine[best(v[p * w : (p + 1) * w], books[p])[1]].append(v[p * w : (p + 1) * w])
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(mine, books[p])]
    found = [[best(v[p * w : (p + 1) * w], books[p]) for p in range(parts)] for v in x]
    error = [sum(d for d, _ in f) for f in found]
    by = Counter()
    for r, e in zip(rows, error):
        by[r[2]] += e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return Counter((r[0], "".join(f"{k:02x}" for _, k in f), e, by[r[2]], digest) for r, f, e in zip(rows, found, error))


def got(df):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    data = [(int(i), rng.normal(size=64).tolist(), [None, 1, 2][i % 3]) for i in rng.permutation(150)]
    data += [(200 + i, data[i][1], 1) for i in range(5)] + [(3, data[7][1], None)]
    wide = frame(spark, data).selectExpr("*", "'x' as v", "1 as kind", "2 as size", "3 as code", "4 as error")
    assert got(V.compress(wide)) == brute(data)


def test_ties_on_a_coarse_grid(spark):
    """Components of few values: most distances tie, and entries are equal."""
    rng = np.random.default_rng(2)
    data = [(i, (rng.integers(-1, 2, 32) / 256).tolist(), 0) for i in range(200)]
    for cfg in (V.CodeConfig(), V.CodeConfig(degree=2), V.CodeConfig(degree=1, entries=20)):
        assert got(V.compress(frame(spark, data), cfg)) == brute(data, entries=cfg.entries)


def test_awkward_rows(spark):
    v = np.linspace(-1, 1, 16).tolist()
    data = [
        (5, None, 1), (6, [], 1), (7, [None] + v[1:], 1), (8, [float("nan")] + v[1:], None), (9, [float("-inf")] + v[1:], 1),
        (10, v, None), (11, v[::-1], None), (11, v[::-1], 2), (None, [c / 2 for c in v], 2), (12, v + v, 2), (13, v[:7], 2),
    ]
    assert got(V.compress(frame(spark, data))) == brute(data)
    assert V.compress(frame(spark, [])).count() == 0
    assert V.compress(frame(spark, data[:5])).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="no exact squared distance"):
        V.compress(frame(spark, [(1, [1e30] * 16, 1)])).collect()


@pytest.mark.parametrize("degree", [1, 2, 3, 8, 64])
def test_search_finds_the_nearest(degree):
    rng = np.random.default_rng(degree)
    for spread in (1, 3, 1000):
        book = rng.integers(-spread, spread + 1, (64, 4))
        q = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (500, 4)), book])
        who, best = V.nearest(V.grow(book, np.arange(64), degree), q)
        d2 = ((q[:, None] - book[None]) ** 2).sum(axis=2)
        assert (who == d2.argmin(axis=1)).all() and (best == d2.min(axis=1)).all()


def test_subtrees_are_eliminated(monkeypatch):
    """On clustered entries most distances are never taken."""
    rng = np.random.default_rng(9)
    centres = rng.integers(-10_000, 10_000, (8, 4))
    book = np.repeat(centres, 8, axis=0) + rng.integers(-50, 50, (64, 4))
    q = np.repeat(centres, 100, axis=0) + rng.integers(-50, 50, (800, 4))
    tree, taken, plain = V.grow(book, np.arange(64), 8), [], V.squared
    monkeypatch.setattr(V, "squared", lambda a, b: taken.append(len(a) * len(b)) or plain(a, b))
    V.nearest(tree, q)
    assert sum(taken) < 0.5 * len(q) * len(book)
