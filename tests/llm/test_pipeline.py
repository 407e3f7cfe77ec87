"""Each stage over its predecessor's output, and the whole run, against brute
force on the small documents table."""

import random
import re
from collections import Counter

import corpus_pipeline as C
from llm.data import WORD, prose, table
from llm.test_packing import check
from llm.test_simhash import brute_components, brute_fp
from tokenizers import Tokenizer
import public_tokenizers


def corpus(tmp_dir, spark):
    rng = random.Random(6)
    data = [(i, prose(rng, "en", rng.randint(60, 200)), "en", f"src{i % 3}", 0) for i in range(60)]
    data += [(100 + i, data[i][1].replace(" ", "  "), "en", "src0", 0) for i in range(8)]  # equal texts
    data += [(200 + i, data[i + 20][1] + " Fin.", "en", "src1", 0) for i in range(8)]  # near copies
    data += [(300 + i, "bad$$$ line### here%%%\n" * 40, "en", "src2", 0) for i in range(5)]  # junk
    data += [(400, None, None, None, None), (401, "", "en", "src0", 0), (402, "few words.", "en", "src0", 0)]
    data = [(*r[:4], len(r[1] or "")) for r in data]
    table(spark, data).repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    return data


def test_stages_and_run(spark, tmp_dir):
    data = corpus(tmp_dir, spark)
    assert [n for n, _ in C.STAGES] == ["quality_rules", "exact_dedup", "simhash", "mix_sources", "packing"]
    docs = C.documents(spark, tmp_dir)
    names = docs.columns
    kept = []
    for name, stage in C.STAGES[:-1]:
        docs = C.written(stage(spark, docs, tmp_dir), f"test-{name}")
        assert docs.columns == names
        kept.append({r.doc_id: r for r in docs.collect()})
    quality, exact, near, mixed = kept
    assert set(quality) == {r[0] for r in data if r[0] < 300}
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    firsts = {}
    for i in sorted(quality):
        firsts.setdefault(norm(quality[i].text), i)
    assert set(exact) == set(firsts.values())
    ids = sorted(exact)
    comp = brute_components([brute_fp(exact[i].text) for i in ids])
    assert set(near) == {ids[c] for c in comp}
    words = Counter()
    for r in docs.collect():
        words[r.source] += len(WORD.findall(r.text))
    sizes = Counter()
    for r in near.values():
        sizes[r.source] += len(WORD.findall(r.text))
    assert abs(sum(words.values()) - 1.5 * sum(sizes.values())) <= len(sizes)
    assert all(words[s] <= 2 * sizes[s] for s in sizes)
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    one = {}
    for r in docs.collect():
        one.setdefault(r.doc_id, []).append(r.text)
    single = docs.where(docs.doc_id.isin([i for i, t in one.items() if len(t) == 1]))
    pieces = C.STAGES[-1][1](spark, single, tmp_dir).collect()
    check([(r.doc_id, r.text) for r in single.collect()], pieces, encoder)
    total = sum(r.length for r in C.run(spark, tmp_dir).collect())
    assert total == sum(len(encoder.encode(t, add_special_tokens=False).ids) + 1 for ts in one.values() for t in ts)


def test_stages_pass_other_columns_through(spark, tmp_dir):
    from llm.data import with_extra

    corpus(tmp_dir, spark)
    docs = with_extra(C.documents(spark, tmp_dir))
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, tmp_dir)
        assert out.columns == docs.columns and {r.taken for r in out.collect()} == {"x"}


def test_empty_table(spark, tmp_dir):
    table(spark, []).write.parquet(f"{tmp_dir}/documents.parquet")
    assert C.run(spark, tmp_dir).count() == 0
