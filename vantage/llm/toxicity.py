"""Toxicity by a convolutional text classifier in numpy.

Words are embedded by hashing: the sum of the table rows of two hashes of the
word (words sharing one bucket rarely share both) and of its beginnings, which
carry stems over to inflected forms. Filters of several widths
slide over the words, each filter's largest response in the text is kept, and
a logistic layer scores the responses. Training is stochastic AdaGrad on a
bounded sample of labelled rows; scoring covers every word of every text.

Thresholds are calibrated by language. The language is guessed from the text
by function words learned in training, never from a column: per language, the
logit threshold with the best F1 over all labelled rows of one fold, which is
kept from training (the common threshold where a language has few positives).
These rows are counted in a histogram of logits by guessed language and label,
so the cut follows the mix of the whole fold, whatever its size. A score is the
logistic of the logit's distance to the threshold, so 0.5 is the calibrated cut.

Defined results: a null or empty text is scored like a text whose windows are
all padding; labels that are null or whose id is null are ignored, of repeated
ids the larger label counts; repeated rows are scored row by row; without
labelled rows of both kinds every score is 0.5 less a margin (label 0); an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.shared import FOLDS, fold, numbered_words, spread_text, text_blocks, written


@dataclass(frozen=True)
class ToxicityConfig:
    """``train_rows`` bounds the labelled rows of each class, ``train_chars``
    the characters of a text among them: the rows are drawn from shorter texts,
    and where a class has too few of these, also from longer ones, of which
    pieces from all over the text are taken. ``bins`` is the number of
    histogram bins per unit of the logit."""

    train_rows: int = 2000
    train_chars: int = 12_000
    buckets: int = 1 << 18
    stems: tuple[int, ...] = (3, 4, 5, 6, 7, 8)
    dims: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 16
    epochs: int = 6
    batch: int = 32
    rate: float = 0.03
    calibration_fold: int = 1
    bins: int = 64
    widest: float = 64.0
    min_positives: int = 8
    language_words: int = 120
    block_bytes: int = 2 << 20
    seed: int = 11


def bare(word: str) -> str:
    """Lower case, without signs at either end."""
    if word.isalpha():
        return word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b].lower()


def word_rows(words: list[bytes], cfg: ToxicityConfig) -> tuple[np.ndarray, list[str]]:
    """((words, rows of each) table rows, bare words): two hashes of the whole
    word and one of each of its proper beginnings of ``cfg.stems`` letters.
    Row ``buckets`` is the zero row, for what a word doesn't have; END and
    words without letters or digits have nothing."""
    plain = ["", *map(bare, b"\n".join(words[1:]).decode("utf-8", "replace").split("\n"))] if len(words) > 1 else [""] * len(words)
    n = len(plain)
    sizes = np.fromiter(map(len, plain), np.int64, n)
    text = np.frombuffer("".join(plain).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    text = np.append(text, np.uint64(0))
    begin = np.cumsum(sizes) - sizes
    mult = np.uint64(0x9E3779B97F4A7C15)
    rows = np.full((n, 2 + len(cfg.stems)), cfg.buckets, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(int(sizes.max(initial=0))):
        live = np.flatnonzero(sizes > k)
        h[live] = (h[live] ^ (h[live] >> np.uint64(31)) ^ text[begin[live] + k]) * mult + np.uint64(1)
        if k + 1 in cfg.stems:
            has = np.flatnonzero(sizes > k + 1)
            rows[has, 2 + cfg.stems.index(k + 1)] = _bucket(h[has], k + 2, cfg.buckets)
    has = np.flatnonzero(sizes > 0)
    rows[has, 0] = _bucket(h[has], 0, cfg.buckets)
    rows[has, 1] = _bucket(h[has], 1, cfg.buckets)
    return rows, plain


def _bucket(h: np.ndarray, kind: int, buckets: int) -> np.ndarray:
    h = (h ^ np.uint64(kind * 0x51ED27 + 1)) * np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Model:
    cfg: ToxicityConfig
    table: np.ndarray  # (buckets + 1, dims), the zero row last
    kernels: list[np.ndarray]  # per width: (width, dims, filters)
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    language: dict[str, int] = field(default_factory=dict)
    languages: int = 0
    threshold: list[float] = field(default_factory=list)  # per language; the last for none

    def embed(self, rows: np.ndarray) -> np.ndarray:
        return sum(self.table[rows[:, k]] for k in range(rows.shape[1]))

    def responses(self, e: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Per width, the filters' responses at every position. ``e`` embeds
        distinct words, ``at`` numbers them in order; number 0 closes a text
        and windows that start there see padding only."""
        n = len(at)
        closed = at == 0
        result = []
        for kernel, bias in zip(self.kernels, self.bias):
            r = np.broadcast_to(bias, (n, len(bias))).copy()
            open_window = ~closed
            for j in range(len(kernel)):
                part = (e @ kernel[j])[at[j:]]
                ok = open_window[: n - j]
                r[: n - j][ok] += part[ok]
                open_window = open_window[: n - j].copy()
                open_window &= ~closed[j:]
            result.append(r)
        return result

    def logits(self, e: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One per text."""
        first = np.concatenate([[0], np.flatnonzero(at == 0)[:-1] + 1])
        pooled = np.concatenate([np.maximum.reduceat(r, first, axis=0) for r in self.responses(e, at)], axis=1)
        return np.maximum(pooled, 0) @ self.out + self.out_bias

    def guess(self, plain: list[str], at: np.ndarray) -> np.ndarray:
        """Language number of each text, ``languages`` where no word tells."""
        text = np.cumsum(at == 0) - (at == 0)
        vote = np.array([self.language.get(w, -1) for w in plain])[at]
        has = vote >= 0
        n = int((at == 0).sum())
        tally = np.bincount(text[has] * (self.languages + 1) + vote[has], minlength=n * (self.languages + 1))
        tally = tally.reshape(n, self.languages + 1)
        return np.where(tally.any(axis=1), tally.argmax(axis=1), self.languages)

    def judge(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logit, language number) of each text."""
        words, at = numbered_words([(t or "").encode("utf-8", "surrogatepass") for t in texts])
        rows, plain = word_rows(words, self.cfg)
        return self.logits(self.embed(rows), at), self.guess(plain, at)


def _start(cfg: ToxicityConfig) -> Model:
    rng = np.random.default_rng(cfg.seed)
    table = np.zeros((cfg.buckets + 1, cfg.dims), np.float32)
    table[:-1] = rng.normal(0, 0.01, (cfg.buckets, cfg.dims))
    kernels = [rng.normal(0, 0.5, (w, cfg.dims, cfg.filters)).astype(np.float32) for w in cfg.widths]
    bias = [np.zeros(cfg.filters, np.float32) for _ in cfg.widths]
    out = np.abs(rng.normal(0, 0.3, cfg.filters * len(cfg.widths))).astype(np.float32)
    out[::3] *= -1
    return Model(cfg, table, kernels, bias, out, 0.0)


def _step(m: Model, texts: list[tuple[np.ndarray, int]], weight: tuple[float, float], moments: dict) -> None:
    """One AdaGrad step. ``texts``: (table rows per word, -1 for the closing
    END, label)."""
    cfg = m.cfg
    rows = np.concatenate([t for t, _ in texts])
    label = np.array([y for _, y in texts], np.float32)
    closed = rows[:, 0] == -1
    rows = np.where(closed[:, None], cfg.buckets, rows)
    number = np.where(closed, 0, np.arange(1, len(rows) + 1))
    e = np.concatenate([np.zeros((1, cfg.dims), np.float32), m.embed(rows)])
    first = np.concatenate([[0], np.flatnonzero(closed)[:-1] + 1])
    stops = np.flatnonzero(closed) + 1
    resp = m.responses(e, number)
    best = [np.stack([a + r[a:b].argmax(axis=0) for a, b in zip(first, stops)]) for r in resp]
    pooled = np.concatenate([np.take_along_axis(r, p, 0) for r, p in zip(resp, best)], axis=1)
    active = np.maximum(pooled, 0)
    z = active @ m.out + m.out_bias
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    dz = (p - label) * np.where(label > 0, weight[1], weight[0]) / len(texts)
    d_active = np.outer(dz, m.out) * (pooled > 0)
    grads = {"out": active.T @ dz, "out_bias": np.array(dz.sum())}
    d_e = np.zeros_like(e)
    f = cfg.filters
    for k, (kernel, pos) in enumerate(zip(m.kernels, best)):
        d = d_active[:, k * f : (k + 1) * f]
        grads[f"bias{k}"] = d.sum(axis=0)
        g = np.zeros_like(kernel)
        open_window = ~closed[pos]
        for j in range(len(kernel)):
            at = np.minimum(pos + j, len(number) - 1)
            dj = np.where(open_window, d, 0)
            emb = e[number[at]]  # (texts, filters, dims)
            g[j] = np.einsum("tfd,tf->df", emb, dj)
            np.add.at(d_e, number[at].ravel(), (dj[:, :, None] * kernel[j].T[None]).reshape(-1, cfg.dims))
            open_window &= ~closed[np.minimum(pos + j, len(closed) - 1)]
        grads[f"kernel{k}"] = g
    touched = np.flatnonzero(d_e[1:].any(axis=1))
    flat = rows[touched]
    own, inverse = np.unique(flat, return_inverse=True)
    g = np.zeros((len(own), cfg.dims), np.float32)
    np.add.at(g, inverse.reshape(flat.shape), d_e[1:][touched][:, None, :])
    g[own == cfg.buckets] = 0
    moment = moments.setdefault("table", np.full((cfg.buckets + 1, cfg.dims), 1e-6, np.float32))
    moment[own] += g * g
    m.table[own] -= cfg.rate * g / np.sqrt(moment[own])
    params = {"out": m.out} | {f"bias{k}": b for k, b in enumerate(m.bias)} | {f"kernel{k}": w for k, w in enumerate(m.kernels)}
    for name, value in params.items():
        moment = moments.setdefault(name, np.full_like(value, 1e-6))
        moment += grads[name] ** 2
        value -= (cfg.rate * grads[name] / np.sqrt(moment)).astype(value.dtype)
    moment = moments.setdefault("out_bias", np.array(1e-6))
    moment += grads["out_bias"] ** 2
    m.out_bias -= float(cfg.rate * grads["out_bias"] / np.sqrt(moment))


def best_threshold(logit: np.ndarray, label: np.ndarray) -> float:
    """The cut with the best F1, in the middle of its gap."""
    order = np.argsort(-logit, kind="stable")
    x, y = logit[order], label[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    same = np.append(x[1:] == x[:-1], False)
    f1[same] = -1
    k = int(f1.argmax())
    return float(x[k] - 1 if k + 1 == len(x) else (x[k] + x[k + 1]) / 2)


def train(samples: list[tuple[str, str | None, int, bool]], cfg: ToxicityConfig) -> Model:
    """``samples``: (text, language, label, set aside for calibration)."""
    m = _start(cfg)
    counts: dict[str, Counter] = {}
    for text, lang, _, _ in samples:
        if lang is not None:
            counts.setdefault(lang, Counter()).update({bare(w.decode("utf-8", "replace")) for w in (text or "").encode().split()})
    names = sorted(counts)
    total = sum(counts.values(), Counter())
    for k, lang in enumerate(names):
        common = sorted(counts[lang].items(), key=lambda x: (-x[1], x[0]))
        own = [w for w, n in common if w and 2 * n > total[w]][: cfg.language_words]
        m.language |= dict.fromkeys(own, k)
    m.languages = len(names)
    m.threshold = [0.0] * (len(names) + 1)

    encoded = []
    for text, _, label, aside in samples:
        words, at = numbered_words([(text or "").encode()])
        rows, plain = word_rows(words, cfg)
        rows[0] = -1
        encoded.append((rows[at], label, aside))
    learn = [(r, y) for r, y, aside in encoded if not aside]
    n1 = sum(y for _, y in learn)
    if not n1 or n1 == len(learn):
        m.out[:] = 0
        m.out_bias = -1.0
        return m
    weight = (len(learn) / (2 * (len(learn) - n1)), len(learn) / (2 * n1))
    rng = np.random.default_rng(cfg.seed)
    moments: dict = {}
    for _ in range(cfg.epochs):
        order = rng.permutation(len(learn))
        for k in range(0, len(order), cfg.batch):
            _step(m, [learn[i] for i in order[k : k + cfg.batch]], weight, moments)

    logit, lang = [], []
    for text, *_ in samples:
        words, at = numbered_words([(text or "").encode()])
        rows, plain = word_rows(words, cfg)
        logit.append(m.logits(m.embed(rows), at)[0])
        lang.append(m.guess(plain, at)[0])
    logit, lang = np.array(logit), np.array(lang)
    label = np.array([y for _, _, y, _ in samples])
    aside = np.array([a for *_, a in samples])
    use = aside if label[aside].sum() >= cfg.min_positives else np.ones(len(samples), bool)
    common = best_threshold(logit[use], label[use])
    m.threshold = [common] * (len(names) + 1)
    for k in range(len(names)):
        sel = use & (lang == k)
        if label[sel].sum() >= cfg.min_positives:
            m.threshold[k] = best_threshold(logit[sel], label[sel])
    return m


def _marked(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled rows outside the held-out fold, one an id."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold() != 0))
    return marked.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))


def sample(docs: DataFrame, labels: DataFrame, cfg: ToxicityConfig) -> list[tuple[str, str | None, int, bool]]:
    """The bounded sample of labelled rows outside the held-out fold."""
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    sizes = texts.select("doc_id", (F.coalesce(F.length("text"), F.lit(0)) <= cfg.train_chars).alias("short"))
    marked = _marked(labels).join(sizes.groupBy("doc_id").agg(F.min("short").alias("short")), "doc_id")
    there = {(r.toxic, r.short): r.n for r in marked.groupBy("toxic", "short").agg(F.count(F.lit(1)).alias("n")).collect()}  # 4 rows
    share = F.lit(0.0)
    for toxic in (0, 1):
        short, long = there.get((toxic, True), 0), there.get((toxic, False), 0)
        own = F.col("toxic") == toxic
        share = F.when(own & F.col("short"), cfg.train_rows / max(1, short)).otherwise(share)
        share = F.when(own & ~F.col("short"), max(0, cfg.train_rows - short) / max(1, long)).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit(cfg.seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # about train_rows ids a class: small enough to send to every task, so that
    # the texts of all other documents stay where they are
    some = F.broadcast(marked.where(place < share).select("doc_id", "toxic"))
    rows = texts.join(some, "doc_id").withColumn("aside", fold() == cfg.calibration_fold % FOLDS)
    rows = rows.select("doc_id", spread_text("text", cfg.train_chars).alias("text"), "lang", "toxic", "aside")
    found = sorted(((r.doc_id, r.text or "", r.lang, r.toxic, r.aside) for r in rows.collect()), key=lambda r: r[:2])
    return [r[1:] for r in found]


def best_cut(bins: np.ndarray, label: np.ndarray, n: np.ndarray) -> float:
    """The cut with the best F1 over a histogram (bin, label, rows), in bins:
    in the middle between the lowest bin above it and the highest below."""
    at, where = np.unique(bins, return_inverse=True)
    hits, all_ = np.zeros(len(at)), np.zeros(len(at))
    np.add.at(hits, where, n * label)
    np.add.at(all_, where, n)
    above, positive = np.cumsum(hits[::-1])[::-1], hits.sum()
    f1 = 2 * above / (np.cumsum(all_[::-1])[::-1] + positive)
    k = len(at) - 1 - int(f1[::-1].argmax())  # of equals the highest cut
    return float(at[k]) if k == 0 else (at[k] + at[k - 1] + 1) / 2


def calibrate(logits: DataFrame, labels: DataFrame, own: Model) -> list[float]:
    """The thresholds by language over all labelled rows of the calibration
    fold; those of the training sample where it has few positives."""
    cfg = own.cfg
    mine = logits.where(fold() == cfg.calibration_fold % FOLDS).join(_marked(labels), "doc_id")
    bound = cfg.widest * cfg.bins
    slot = F.least(F.greatest(F.floor(F.col("logit") * cfg.bins), F.lit(-bound)), F.lit(bound)).cast("int").alias("bin")
    counts = mine.groupBy("guess", "toxic", slot).agg(F.count(F.lit(1)).alias("n"))
    h = counts.toPandas()  # languages * 2 * 2 * widest * bins rows at most
    if (h.n * h.toxic).sum() < cfg.min_positives:
        return own.threshold
    cut = lambda x: best_cut(x["bin"].to_numpy(), x.toxic.to_numpy(), x.n.to_numpy()) / cfg.bins
    out = [cut(h)] * (own.languages + 1)
    for k, x in h.groupby("guess"):
        if k < own.languages and (x.n * x.toxic).sum() >= cfg.min_positives:
            out[k] = cut(x)
    return out


def score(docs: DataFrame, labels: DataFrame, cfg: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per document row."""
    own = train(sample(docs, labels, cfg), cfg)  # travels with the function

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_blocks(batches, cfg.block_bytes):
            logit, guess = own.judge(texts)
            cols = [pa.array(keys, pa.int64()), pa.array(logit.astype(np.float64)), pa.array(guess.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "logit", "guess"])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    logits = written(rows.mapInArrow(run, "doc_id long, logit double, guess int"), "toxic-logits")
    cuts = F.array(*[F.lit(float(t)) for t in calibrate(logits, labels, own)])
    margin = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("logit") - F.get(cuts, F.col("guess"))))
    out = logits.select("doc_id", (1 / (1 + F.exp(-margin))).alias("score"))
    return out.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
