"""Language identification by a linear-chain conditional random field.

Every word of a text gets a language label. A word's features are its hashed
character n-grams, its affixes, the word itself and its membership in learned
per-language lexicons; neighbouring labels are tied by learned transitions.
Forward-backward gives each word's label probabilities, so text that switches
language inside a line is labelled word by word. A document's language is the
label with the largest expected share of its words, and that share the score.

Training maximises the likelihood of word sequences put together from training
documents, switching between languages, with AdaGrad on exact gradients. It
takes a bounded sample of rows (``train_docs`` per language, of each at most
``train_words`` words in runs spread over the whole text, at most ``max_langs``
languages, more are an error); scoring covers every word of every text, in
chains of at most ``chain_words`` words.

Defined results: a null text or one without a letter is ``und`` with score 0;
words without a letter are left out of the chains; repeated rows and ids are
scored row by row; without training rows every text is ``und``; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.shared import fold, hashed_share, numbered_words, spread_text, text_blocks

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageConfig:
    train_docs: int = 300
    train_words: int = 200
    max_langs: int = 500
    lexicon_words: int = 150
    buckets: int = 1 << 16
    chain_words: int = 1024
    sequences: int = 800
    sequence_words: int = 96
    switch_words: int = 24
    steps: int = 120
    batch: int = 80
    rate: float = 0.3
    decay: float = 1e-4
    block_bytes: int = 4 << 20
    seed: int = 7


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def features(words: list[str], lexicon: dict[str, int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers in a row, first feature of each word); every word is
    non-empty lower-case letters."""
    n = len(words)
    text = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, n) + 2
    ends = np.cumsum(sizes)
    begins = ends - sizes
    word = np.repeat(np.arange(n), sizes)
    room = ends[word] - np.arange(len(text))  # characters from here to the word's end
    mult = np.uint64(0x9E3779B97F4A7C15)
    found, owner = [], []

    def put(h: np.ndarray, w: np.ndarray, kind: int) -> None:
        h = (h ^ np.uint64(kind * 0x51ED27)) * np.uint64(0xD6E8FEB86659FD93)
        found.append(((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))
        owner.append(w)

    gram = text * mult
    put(gram, word, 1)
    for size in range(2, 5):
        gram = (gram[:-1] ^ (gram[:-1] >> np.uint64(29)) ^ text[size - 1 :]) * mult
        ok = room[: len(gram)] >= size
        put(gram[ok], word[: len(gram)][ok], size)
        # affixes of this many characters, the word's edge included
        at = begins[sizes >= size + 1]
        put(gram[at], word[at], 10 + size)
        at = (ends - size)[sizes >= size + 1]
        put(gram[at], word[at], 20 + size)
    whole = np.zeros(n, np.uint64)
    np.bitwise_xor.at(whole, word, (text + np.uint64(1)) * mult * (np.arange(len(text)) - begins[word] + 1).astype(np.uint64))
    put(whole, np.arange(n), 30)
    listed = np.fromiter((lexicon.get(w, -1) for w in words), np.int64, n)
    has = np.flatnonzero(listed >= 0)
    put(listed[has].astype(np.uint64) * mult, has, 40)
    owner_all, found_all = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner_all, kind="stable")
    return found_all[order], np.searchsorted(owner_all[order], np.arange(n))


def forward_backward(emit: np.ndarray, trans: np.ndarray, start: np.ndarray, sizes: np.ndarray):
    """Label probabilities (T, D, L) of D chains padded to T words, the
    expected transitions and the log-likelihood's normaliser per chain."""
    t_max, d, n = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e = np.exp(emit - top)
    a = np.exp(trans)
    alive = np.arange(t_max)[:, None] < sizes[None, :]
    alpha = np.empty_like(e)
    scale = np.ones((t_max, d), e.dtype)
    now = np.exp(start) * e[0]
    for t in range(t_max):
        if t:
            now = (now @ a) * e[t]
        s = now.sum(axis=1)
        scale[t] = s
        now = now / s[:, None]
        alpha[t] = now
    beta = np.ones((d, n), e.dtype)
    marginal = np.empty_like(e)
    both = np.zeros((n, n))
    for t in range(t_max - 1, -1, -1):
        live = alive[t][:, None]
        p = alpha[t] * beta
        marginal[t] = np.where(live, p / p.sum(axis=1, keepdims=True), 0)
        if t:
            right = np.where(live, e[t] * beta / scale[t][:, None], 0)
            both += a * (alpha[t - 1].T @ right)
            beta = np.where(live, right @ a.T, 1)
    log_z = np.where(alive, np.log(scale) + top[:, :, 0], 0).sum(axis=0)
    return marginal, both, log_z


@dataclass
class Model:
    langs: list[str]
    lexicon: dict[str, int]
    weight: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    cfg: LanguageConfig

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.langs)), np.float32)
        f, first = features(words, self.lexicon, self.cfg.buckets)
        return np.add.reduceat(self.weight[f], first, axis=0)


def spread_words(words: list[bytes], most: int, runs: int = 8) -> list[bytes]:
    """At most ``most`` words: runs of neighbours, evenly spaced over the text."""
    if len(words) <= most:
        return words
    size = max(1, most // runs)
    room = len(words) - size
    return [w for k in range(runs) for w in words[room * k // (runs - 1) :][:size]]


def train(samples: list[tuple[str, str]], cfg: LanguageConfig) -> Model | None:
    """``samples``: (text, language) of the sampled training rows."""
    langs = sorted({lang for _, lang in samples})
    if not langs:
        return None
    rng = np.random.default_rng(cfg.seed)
    docs: list[list[list[str]]] = [[] for _ in langs]
    for text, lang in samples:
        words = [w for x in spread_words(text.encode().split(), cfg.train_words) if (w := letters(x.decode("utf-8", "ignore").lower()))]
        if words:
            docs[langs.index(lang)].append(words)
    counts = [Counter(w for d in group for w in d) for group in docs]
    total = sum(counts, Counter())
    lexicon: dict[str, int] = {}
    for k, c in enumerate(counts):
        for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[: cfg.lexicon_words]:
            if 2 * n > total[w]:
                lexicon[w] = k
    usable = [k for k, group in enumerate(docs) if group]
    if not usable:
        return None
    vocabulary: dict[str, int] = {}
    seqs, tags = [], []
    for _ in range(cfg.sequences):
        words: list[int] = []
        labels: list[int] = []
        while len(words) < cfg.sequence_words:
            k = usable[rng.integers(len(usable))]
            doc = docs[k][rng.integers(len(docs[k]))]
            size = int(rng.geometric(1 / cfg.switch_words))
            at = int(rng.integers(max(1, len(doc) - size + 1)))
            part = doc[at : at + size]
            words += [vocabulary.setdefault(w, len(vocabulary)) for w in part]
            labels += [k] * len(part)
        seqs.append(words[: cfg.sequence_words])
        tags.append(labels[: cfg.sequence_words])
    x, y = np.array(seqs), np.array(tags)
    f, first = features(list(vocabulary), lexicon, cfg.buckets)
    last = np.append(first[1:], len(f))
    n = len(langs)
    weight = np.zeros((cfg.buckets, n))
    trans, start = np.zeros((n, n)), np.zeros(n)
    moments = [np.full_like(v, 1e-6) for v in (weight, trans, start)]
    sizes = np.full(cfg.batch, x.shape[1])
    for _ in range(cfg.steps):
        pick = rng.integers(len(x), size=cfg.batch)
        xs, ys = x[pick], y[pick]
        used, inverse = np.unique(xs, return_inverse=True)
        lens = last[used] - first[used]
        flat = f[np.repeat(first[used] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())]
        begin = np.cumsum(lens) - lens
        table = np.add.reduceat(weight[flat], begin, axis=0)
        emit = table[inverse.reshape(xs.shape)].transpose(1, 0, 2)
        marginal, both, _ = forward_backward(emit, trans, start, sizes)
        gold = np.eye(n)[ys].transpose(1, 0, 2)
        gap = (gold - marginal).transpose(1, 0, 2).reshape(-1, n)
        per_word = np.stack([np.bincount(inverse.ravel(), gap[:, k], len(used)) for k in range(n)], axis=1)
        spread = np.repeat(per_word, lens, axis=0)
        g_w = np.stack([np.bincount(flat, spread[:, k], cfg.buckets) for k in range(n)], axis=1)
        seen = np.zeros((n, n))
        np.add.at(seen, (ys[:, :-1].ravel(), ys[:, 1:].ravel()), 1)
        grads = (g_w / cfg.batch - cfg.decay * weight, (seen - both) / cfg.batch, (gold[0] - marginal[0]).mean(axis=0))
        for value, grad, moment in zip((weight, trans, start), grads, moments):
            moment += grad * grad
            value += cfg.rate * grad / np.sqrt(moment)
    return Model(langs, lexicon, weight.astype(np.float32), trans, start, cfg)


def label_words(texts: list[str | None], model: Model) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, probabilities of the labels of some of its words, (words,
    languages)); a text without letters yields nothing."""
    raw, at = numbered_words([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    plain = [letters(w) for w in b"\n".join(raw[1:]).decode("utf-8", "replace").lower().split("\n")] if len(raw) > 1 else []
    distinct: dict[str, int] = {}
    number = np.array([-1] + [distinct.setdefault(w, len(distinct)) if w else -1 for w in plain])
    emit = model.emissions(list(distinct)).astype(np.float64)
    text_no = np.cumsum(at == 0) - (at == 0)
    word = number[at]
    keep = word >= 0
    word, text_no = word[keep], text_no[keep]
    if not len(word):
        return
    size = model.cfg.chain_words
    new = np.flatnonzero(np.diff(text_no, prepend=-1))
    lens = np.diff(np.append(new, len(text_no)))
    pieces = -(-lens // size)
    owner = np.repeat(np.arange(len(new)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = new[owner] + nth * size
    length = np.minimum(size, lens[owner] - nth * size)
    order = np.argsort(-length, kind="stable")
    at_order = 0
    while at_order < len(order):
        longest = int(length[order[at_order]])
        group = order[at_order : at_order + max(1, 300_000 // longest)]
        at_order += len(group)
        cols = begin[group][None, :] + np.minimum(np.arange(longest)[:, None], length[group][None, :] - 1)
        marginal, _, _ = forward_backward(emit[word[cols]], model.trans, model.start, length[group])
        for k, g in enumerate(group):
            yield int(text_no[begin[g]]), marginal[: length[g], k]


def sample(docs: DataFrame, cfg: LanguageConfig) -> list[tuple[str, str]]:
    """The bounded training sample: texts (of long ones pieces from all over)
    and languages of rows outside the held-out fold."""
    rows = docs.where(F.col("lang").isNotNull() & (fold() != 0) & F.col("text").isNotNull())
    rows = rows.select(F.col("doc_id"), F.col("lang").cast("string"), F.col("text").cast("string"))
    if rows.select("lang").distinct().limit(cfg.max_langs + 1).count() > cfg.max_langs:
        raise ValueError(f"more than {cfg.max_langs} languages to learn")
    some = hashed_share(rows, "doc_id", "lang", cfg.train_docs, cfg.seed)
    some = some.select("doc_id", "lang", spread_text("text", 16 * cfg.train_words).alias("text"))
    return sorted((r.text, r.lang) for r in some.collect())


def identify(docs: DataFrame, model: Model | None = None, cfg: LanguageConfig = LanguageConfig()) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_switches (label changes between
    neighbouring words), one row per document row."""
    own = model or train(sample(docs, cfg), cfg)  # travels with the function

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_blocks(batches, cfg.block_bytes):
            n = len(texts)
            langs = own.langs if own else []
            mass, words, switches = np.zeros((n, max(1, len(langs)))), np.zeros(n), np.zeros(n, np.int64)
            for k, p in label_words(texts, own) if own else ():
                mass[k] += p.sum(axis=0)
                words[k] += len(p)
                best = p.argmax(axis=1)
                switches[k] += int((best[1:] != best[:-1]).sum())
            best = mass.argmax(axis=1)
            named = [langs[b] if w else UNDETERMINED for b, w in zip(best, words)]
            score = np.where(words > 0, mass[np.arange(n), best] / np.maximum(words, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(named, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(switches)],
                names=["doc_id", "lang_pred", "score", "n_switches"],
            )

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    out = rows.mapInArrow(run, "doc_id long, lang_pred string, score double, n_switches long")
    return out.select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score", "n_switches")
