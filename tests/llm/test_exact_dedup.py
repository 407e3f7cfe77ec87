import hashlib
import re

from llm.data import as_set, rows, table, with_extra
from vantage.llm import exact_dedup as E
from vantage.session import scratch_path

COLS = ["doc_id", "keep_id", "group_size", "text_sha256"]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(data):
    groups = {}
    for r in data:
        groups.setdefault(norm(r[1]), []).append(r[0])
    out = []
    for r in data:
        ids = groups[norm(r[1])]
        keep = min((i for i in ids if i is not None), default=None)
        out.append((r[0], keep, len(ids), hashlib.sha256(norm(r[1]).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    data = rows()
    got = E.decisions(with_extra(table(spark, data)))
    assert as_set(got, *COLS) == brute(data)
    kept = [r.text_sha256 for r in got.where("kept").collect()]
    assert len(kept) == len(set(kept)) == len({norm(r[1]) for r in data})


def test_empty_table(spark):
    assert E.decisions(table(spark, [])).count() == 0


def test_files_as_input_and_hot_group(spark, tmp_dir):
    data = [(i, "same text" if i % 3 else f"own text {i}", "en", "s", 1) for i in range(600)]
    table(spark, data).repartition(5).write.parquet(f"{tmp_dir}/docs")
    docs = spark.read.parquet(f"{tmp_dir}/docs")
    assert as_set(E.decisions(docs), *COLS) == brute(data)
    left = E.deduplicated(docs)
    assert left.columns == docs.columns and left.count() == 201


def test_state_goes_on_with_new_rows(spark, tmp_dir):
    folder, state = f"{tmp_dir}/in", scratch_path(spark, "state")
    schema = "doc_id long, loc_file string, loc_row long, digest binary"
    for k, ids in enumerate(([5, 7], [3])):
        part = [(i, f"f{k}", n, b"d") for n, i in enumerate(ids)]
        spark.createDataFrame(part, schema).write.mode("append").parquet(folder)
        seen = E.absorb(spark, folder, state, spark.createDataFrame([], schema).schema, 2).collect()
    assert [(r.group_size, r["first"].doc_id, r["first"].loc_file) for r in seen] == [(3, 3, "f1")]


def test_equal_digests_of_different_texts(spark, monkeypatch):
    from pyspark.sql import functions as F

    real = F.sha2
    monkeypatch.setattr(E.F, "sha2", lambda c, n: real(F.substring(c, 1, 1), n))
    data = [(1, "ab", "e", "s", 1), (2, "ac", "e", "s", 1), (3, "ab", "e", "s", 1), (4, "b", "e", "s", 1)]
    got = as_set(E.decisions(table(spark, data)), "doc_id", "keep_id", "group_size", "kept")
    assert got == [(1, 1, 2, True), (2, 2, 1, True), (3, 1, 2, False), (4, 4, 1, True)]
