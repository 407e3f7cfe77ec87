import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.data import prose, rows, table, with_extra
from vantage.llm import packing as P


@pytest.fixture(scope="module")
def encoder():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(encoder, text):
    return np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(data, pieces, encoder, length=2048):
    """Every id in exactly one piece, sequences gapless; returns the padding share."""
    data = list(data)
    by, seqs = {}, {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for doc in {r[0] for r in data}:
        texts = [r[1] for r in data if r[0] == doc]
        ids = ids_of(encoder, texts[0])
        own = sorted(by[doc], key=lambda p: p.start)
        if len(texts) > 1:
            assert sum(p.length for p in own) == len(ids) * len(texts)
            continue
        at = 0
        for p in own:
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length])
            at += p.length
        assert at == len(ids)
    pad = total = 0
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= length
        total += at
        pad += 0 if at & (at - 1) == 0 else length - at
    return pad / (pad + total)


def test_round_trip(spark, encoder):
    data = rows()
    pieces = P.pack(with_extra(table(spark, data))).collect()
    assert check(data, pieces, encoder) < 0.1


def test_streams_of_many_chunks_have_little_padding(spark, encoder):
    rng = random.Random(3)
    data = [(i, prose(rng, "en", rng.randint(20, 1500)), "en", "s", 1) for i in range(150)]
    pieces = P.pack(table(spark, data).coalesce(1), P.PackConfig(chunk_ids=20_000, cache_words=50)).collect()
    assert check(data, pieces, encoder) < 0.02


def test_empty_table(spark):
    assert P.pack(table(spark, [])).count() == 0


def test_with_ids(spark, encoder):
    data = [(1, "Hello there. General words", "en", "s", 1), (2, None, "en", "s", 1)]
    got = {}
    for r in sorted(P.pack(table(spark, data).coalesce(1), with_ids=True).collect(), key=lambda r: r.start):
        got[r.doc_id] = got.get(r.doc_id, []) + r.ids
    assert got == {i: ids_of(encoder, t).tolist() for i, t, *_ in data}


@pytest.mark.parametrize("text", [
    "", "don't  stop\tnow", "<|endoftext|> x <|startoftext|>y", "ÀÉ œuvre İstanbul ΣΟΦΟΣ", "1234 a1b2 --- ...!!", "é   x y",
    "a\x1cb \x85 c", "日本語 テキスト", "..., it's we'll I'd o'clock 's", "́abc x́ ²³ ªº µ", "ß ẞ ﬁ", "x" * 3000,
])
def test_word_cache_equals_the_tokenizer(encoder, text):
    ids, sizes = P.WordTokens("word_bpe_49k.json", 100).encode([text.encode(), b"again " + text.encode()], 1)
    want = [*ids_of(encoder, text), *ids_of(encoder, "again " + text)]
    assert ids.tolist() == [int(i) for i in want] and len(sizes) == 2


def test_cuts_are_optimal():
    rng = np.random.default_rng(4)
    cfg = P.PackConfig(length=32)
    for _ in range(30):
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 12, 25))])
        pen = rng.integers(0, 6, 26).astype(float)
        best = [0.0] + [np.inf] * 25
        for j in range(1, 26):
            for i in range(j):
                n = at[j] - at[i]
                if n <= 32:
                    cost = {16: 1, 8: 2}.get(n, 32 - n)
                    best[j] = min(best[j], best[i] + min(cost, 32 - n) + pen[j])
        got, last = 0.0, 0
        for c in P.cuts(at, pen, cfg):
            n = c - last
            got += min({16: 1, 8: 2}.get(n, 32 - n), 32 - n) + pen[list(at).index(c)]
            last = c
        assert got == best[25] and last == at[-1]
