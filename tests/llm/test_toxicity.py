import random

import numpy as np

from llm.data import prose, rows, table, with_extra
from vantage.llm import toxicity as X

CFG = X.ToxicityConfig(buckets=1 << 12, filters=6, epochs=10, rate=0.06, batch=16)
BAD = ["zorgul", "blaxit", "krumbo"]


def corpus(n=500, seed=3):
    """Labelled prose; toxic texts hold one of three words or an inflected stem."""
    rng = random.Random(seed)
    data, labels = [], []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        words = prose(rng, lang, rng.randint(10, 80)).split(" ")
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                w = rng.choice(BAD) if lang == "en" else "grimstock" + rng.choice("abcdefgh") + rng.choice("aeiou")
                words.insert(rng.randrange(len(words)), w)
        data.append((i, " ".join(words), lang, f"src{i % 2}", 1))
        labels.append((i, 1, int(toxic)))
    return data, labels


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    data, labels = corpus()
    out = X.score(with_extra(table(spark, data)), label_table(spark, labels), CFG).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r.held_out]
    assert len(held) > 60
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_held_out_labels_and_columns_are_no_inputs(spark):
    data, labels = corpus(200)
    base = {r.doc_id: r.score for r in X.score(table(spark, data), label_table(spark, labels), CFG).collect()}
    held = {r.doc_id for r in table(spark, data).where(X.fold() == 0).collect()}
    other_labels = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    other_docs = [(i, t, None if i in held else lang, "elsewhere", 7) for i, t, lang, _, _ in data]
    again = {r.doc_id: r.score for r in X.score(table(spark, other_docs), label_table(spark, other_labels), CFG).collect()}
    assert again == base


def test_awkward_rows(spark):
    data, labels = corpus(120)
    docs = table(spark, data + rows())
    odd = labels + [(None, 1, 1), (5, 1, None), (8, 0, 1), (8, 0, 1)]
    out = X.score(docs, label_table(spark, odd), CFG).collect()
    assert len(out) == len(data) + len(rows()) and all(r.score is not None for r in out)
    assert X.score(table(spark, []), label_table(spark, labels), CFG).count() == 0


def test_without_labels_of_both_kinds(spark):
    data, labels = corpus(60)
    some = [x for x in labels if x[2] == 0]
    for chosen in (some, []):
        assert {r.predicted for r in X.score(table(spark, data), label_table(spark, chosen), CFG).collect()} == {0}


def test_responses_equal_plain_convolution():
    m = X._start(CFG)
    rng = np.random.default_rng(2)
    m.table[:-1] = rng.normal(size=m.table[:-1].shape)
    texts = ["one two three four", "", "five"]
    words, at = X.numbered_words([t.encode() for t in texts])
    rows_, _ = X.word_rows(words, CFG)
    e = m.embed(rows_)
    got = m.responses(e, at)
    k = 0
    for t in texts:
        vec = [e[words.index(w.encode())] for w in t.split()]
        for i in range(len(vec) + 1):
            for kernel, bias, r in zip(m.kernels, m.bias, got):
                want = bias + sum(vec[i + j] @ kernel[j] for j in range(len(kernel)) if i + j < len(vec))
                assert np.allclose(r[k], want, atol=1e-5)
            k += 1


def test_gradient_lowers_the_loss():
    data, labels = corpus(80)
    m = X._start(CFG)
    enc = []
    for d, (_, _, y) in zip(data, labels):
        words, at = X.numbered_words([d[1].encode()])
        r, _ = X.word_rows(words, CFG)
        r[0] = -1
        enc.append((r[at], y))

    def loss():
        total = 0.0
        for d, (_, _, y) in zip(data, labels):
            words, at = X.numbered_words([d[1].encode()])
            r, _ = X.word_rows(words, CFG)
            z = m.logits(m.embed(r), at)[0]
            total += np.logaddexp(0, -z if y else z)
        return total

    before, moments = loss(), {}
    for _ in range(30):
        X._step(m, enc, (1.0, 1.0), moments)
    assert loss() < 0.5 * before


def test_best_threshold():
    x, y = np.array([0.1, 0.4, 0.6, 0.9]), np.array([0, 0, 1, 1])
    assert np.isclose(X.best_threshold(x, y), 0.5)
    assert X.best_threshold(np.array([1.0, 1.0]), np.array([1, 0])) < 1


def test_best_cut():
    bins, label, n = np.array([-9, -2, 3, 7, 7]), np.array([0, 0, 1, 1, 0]), np.array([50, 4, 6, 9, 1])
    assert X.best_cut(bins, label, n) == 1.0  # between bin -2 and bin 3
    f1 = lambda c: 2 * (n * label)[bins >= c].sum() / (n[bins >= c].sum() + (n * label).sum())
    rng = np.random.default_rng(1)
    for _ in range(200):
        bins, label, n = rng.integers(-9, 9, 12), rng.integers(0, 2, 12), rng.integers(1, 9, 12)
        if label.any():
            best = max(f1(c) for c in range(-9, 10))
            assert np.isclose(f1(X.best_cut(bins, label, n)), best)


def test_thresholds_follow_all_labelled_rows_of_the_fold(spark):
    """The cut is that of the whole fold, not of the class-balanced sample."""
    rng = np.random.default_rng(4)
    toxic = rng.random(4000) < 0.05
    logit = rng.normal(size=4000) + 2.5 * toxic
    logits = spark.createDataFrame([(i, float(x), 0) for i, x in enumerate(logit)], "doc_id long, logit double, guess int")
    labels = label_table(spark, [(i, 1, int(t)) for i, t in enumerate(toxic)])
    own = X._start(CFG)
    own.languages, own.threshold = 1, [0.0, 0.0]
    cut = X.calibrate(logits, labels, own)[0]
    mine = np.array([r.doc_id for r in logits.where(X.fold() == CFG.calibration_fold).collect()])
    f1 = lambda c: 2 * (toxic[mine] & (logit[mine] >= c)).sum() / ((logit[mine] >= c).sum() + toxic[mine].sum())
    assert f1(cut) > max(f1(c) for c in np.arange(-2, 5, 1 / 64)) - 0.01
    assert X.calibrate(logits, labels.limit(0), own) == [0.0, 0.0]


def test_long_texts_are_trained_on_where_short_ones_lack(spark):
    data, labels = corpus(120)
    long = [(i, t + " padding" * 40, *more) for i, t, *more in data]
    cfg = X.ToxicityConfig(**{**CFG.__dict__, "train_chars": 200})
    got = X.sample(table(spark, long), label_table(spark, labels), cfg)
    assert sum(y for *_, y, _ in got) > 15 and all(len(t) <= 200 + 8 for t, *_ in got)
    cut = X.ToxicityConfig(**{**CFG.__dict__, "train_rows": 10})
    assert len(X.sample(table(spark, data), label_table(spark, labels), cut)) < 50
