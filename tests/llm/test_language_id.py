import random

import numpy as np
from pyspark.sql import functions as F

from llm.data import prose, rows, table, with_extra
from vantage.llm import language_id as L

CFG = L.LanguageConfig(train_docs=60, train_words=60, sequences=200, sequence_words=40, steps=40, batch=40)


def corpus(n=300):
    rng = random.Random(2)
    langs = ["en", "de", "fr"]
    return [(i, prose(rng, langs[i % 3], rng.randint(5, 120)), langs[i % 3], "s", 1) for i in range(n)]


def test_held_out_accuracy_and_awkward_texts(spark):
    data = corpus() + [(1000 + i, t, None, None, None) for i, t in enumerate([None, "", " \n ", "123 !? 4", "Ω"])]
    out = L.identify(with_extra(table(spark, data)), cfg=CFG)
    got = {r.doc_id: r for r in out.collect()}
    truth = {r[0]: r[2] for r in data[:300]}
    held = [i for i in truth if got[i].held_out]
    assert 30 < len(held) < 100
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [got[1000 + i].lang_pred for i in range(4)] == ["und"] * 4 and got[1000].score == 0
    assert got[1004].lang_pred in ("en", "de", "fr")


def test_held_out_rows_do_not_train(spark):
    docs = table(spark, corpus())
    kept = {r[0] for r in L.sample(docs, CFG)}
    held = {r.text for r in docs.where(L.fold() == 0).collect()}
    assert not any(t.startswith(k) for k in kept for t in held if k)


def test_code_switched_text_is_labelled_by_word(spark):
    model = L.train(L.sample(table(spark, corpus()), CFG), CFG)
    rng = random.Random(8)
    parts = [("en", 30), ("de", 30), ("fr", 30)]
    text = " ".join(prose(rng, lang, n).replace("\n", " ") for lang, n in parts)
    (_, p), = L.label_words([text], model)
    found = [model.langs[k] for k in p.argmax(axis=1)]
    want = [lang for lang, n in parts for _ in range(n)]
    assert np.mean([a == b for a, b in zip(found, want)]) > 0.9
    assert np.allclose(p.sum(axis=1), 1)


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    emit, trans, start = rng.normal(size=(4, 2, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    sizes = np.array([4, 2])
    marginal, _, log_z = L.forward_backward(emit, trans, start, sizes)
    for d, n in enumerate(sizes):
        total, sums = 0.0, np.zeros((4, 3))
        for path in np.ndindex(*[3] * n):
            score = start[path[0]] + sum(emit[t, d, path[t]] for t in range(n)) + sum(trans[path[t], path[t + 1]] for t in range(n - 1))
            total += np.exp(score)
            for t in range(n):
                sums[t, path[t]] += np.exp(score)
        assert np.isclose(log_z[d], np.log(total))
        assert np.allclose(marginal[:, d], sums / total)


def test_long_texts_and_blocks_do_not_matter(spark):
    model = L.train(L.sample(table(spark, corpus()), CFG), CFG)
    long = prose(random.Random(1), "de", 5000)
    one = list(L.label_words([long, "the and"], model))
    assert sum(len(p) for k, p in one if k == 0) == 5000
    assert L.identify(table(spark, [(1, long, "de", "s", 1)]), model, CFG).first().lang_pred == "de"


def test_without_training_rows_and_empty_table(spark):
    docs = table(spark, [(1, "some words", None, "s", 1)])
    assert L.identify(docs, cfg=CFG).first().lang_pred == "und"
    assert L.identify(table(spark, []), cfg=CFG).count() == 0


def test_null_and_repeated_ids(spark):
    out = L.identify(table(spark, rows()), cfg=CFG)
    assert out.count() == len(rows())
    assert out.where(F.col("doc_id").isNull()).first().held_out is True


def test_training_words_come_from_the_whole_text():
    words = [b"a"] * 500 + [b"b"] * 500
    some = L.spread_words(words, 40)
    assert len(some) == 40 and some.count(b"a") == 20
    assert L.spread_words(words[:30], 40) == words[:30]
