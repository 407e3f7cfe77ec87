import hashlib
from collections import Counter

import pytest

from llm.data import WORD, as_set, rows, table, with_extra
from vantage.llm import mixing as M


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def brute(data):
    size = lambda r: len(WORD.findall(r[1] or ""))
    name = lambda r: "null:" + hashlib.md5((r[1] or "").encode()).hexdigest() if r[0] is None else r[0]
    sizes = Counter()
    for r in data:
        sizes[r[3]] += size(r)
    target = brute_targets(sizes)
    out = []
    for s in sizes:
        own = [r for r in data if r[3] == s]
        own.sort(key=lambda r: (hashlib.md5(f"mix-1:{name(r)}".encode()).hexdigest(), size(r)))
        budget, taken = int(target[s]), [0] * len(own)
        while budget > 0 and sizes[s]:
            for k, r in enumerate(own):
                n = min(size(r), budget)
                taken[k] += n
                budget -= n
        out += [(r[0], size(r), sizes[s], round(target[s], 6), t) for r, t in zip(own, taken)]
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    data = rows()
    got = [(*r[:3], round(r[3], 6), r[4]) for r in as_set(M.mix(with_extra(table(spark, data))), "doc_id", "size", "source_size", "target", "taken")]
    assert sorted(got, key=repr) == brute(data)


def test_sources_meet_their_budget(spark):
    per = {}
    for r in M.mix(table(spark, rows(3, 90))).collect():
        t = per.setdefault(r.source, [0, r.target])
        t[0] += r.taken
        assert r.taken <= 2 * r.size
    assert all(n == int(t) for n, t in per.values())


def test_take_gives_the_taken_words(spark):
    docs = table(spark, [r for r in rows() if r[0] is not None][:70])
    words = Counter()
    for r in M.take(docs).collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id] += len(WORD.findall(r.text))
    want = {r.doc_id: r.taken for r in M.mix(docs).collect() if r.taken}
    assert dict(words) == want


def test_shortened_text_is_a_beginning(spark):
    docs = table(spark, rows(2, 40)[:40])
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert all(whole[r.doc_id].startswith(r.text) for r in M.take(docs).collect())


@pytest.mark.parametrize("data", [[], [(1, None, "en", None, 0)], [(1, "", "en", "a", 0), (2, " ", "en", "b", 0)]])
def test_without_words(spark, data):
    got = M.mix(table(spark, data)).collect()
    assert len(got) == len(data) and all(r.taken == 0 for r in got)
    assert M.take(table(spark, data)).count() == 0


def test_take_keeps_to_the_plan_under_repeated_ids(spark):
    """Rows that repeat an id, with equal and other sizes, are told apart."""
    data = [(k % 5, " ".join(f"w{k}x{j}" for j in range(10 + k % 3)), "en", f"s{k % 2}", 0) for k in range(60)]
    data += [(None, "a b c", "en", "s0", 0)] * 4
    docs = table(spark, data)
    planned, given = Counter(), Counter()
    for r in M.mix(docs).collect():
        planned[r.source] += r.taken
    for r in M.take(docs).collect():
        given[r.source] += len(WORD.findall(r.text))
    assert given == planned
