"""COCO documents: each is written by a task of its own; elements leave the
JSON reader in batches."""

import glob
import json

import pytest

from vantage.sources import coco, sinks
from vantage.sources.json_arrays import _Split


def raw(spark):
    images = spark.range(60).selectExpr("id as pos", "id", "concat('train/', id, '.png') as file_name", "1.5D as width", "2D as height")
    ann = spark.range(300).selectExpr("id % 3 as pos", "id div 2 as id", "id % 60 as image_id", "id % 4 as category_id",
                                      "if(id % 5 = 0, null, 7D) as area", "array(0D, 0D, 1D, 2D) as bbox")
    return images, ann, spark.range(4).selectExpr("id as pos", "id", "concat('c', id) as name")


def test_each_document_is_a_file_of_its_own_task(spark, tmp_dir):
    images, ann, cats = raw(spark)
    ann = ann.unionByName(ann.where("id < 10"))  # equal rows
    sinks.write_coco(images, ann, cats, f"{tmp_dir}/d", 6)
    docs = [json.load(open(f)) for f in sorted(glob.glob(f"{tmp_dir}/d/part-*"))]
    assert len(docs) == 6 and all(len(d["categories"]) == 4 for d in docs)
    assert sorted(x["id"] for d in docs for x in d["images"]) == list(range(60))
    assert sum(len(d["annotations"]) for d in docs) == 320
    for d in docs:
        assert {x["image_id"] for x in d["annotations"]} <= {x["id"] for x in d["images"]}
        assert [x["id"] for x in d["images"]] == sorted(x["id"] for x in d["images"])
    got = coco.read_coco_splits(spark, {"train": f"{tmp_dir}/d"})
    want = coco.raw_tables(coco.read_coco_document(spark, f"{tmp_dir}/d"), "train")
    for g, w in zip(got, want):
        assert sorted(map(repr, g.collect())) == sorted(map(repr, w.collect()))


def test_documents_without_elements(spark, tmp_dir):
    images, ann, cats = raw(spark)
    sinks.write_coco(images.limit(0), ann.limit(0), cats.limit(0), f"{tmp_dir}/d", 3)
    docs = [json.load(open(f)) for f in glob.glob(f"{tmp_dir}/d/part-*")]
    assert docs == [{"images": [], "annotations": [], "categories": []}] * 3


@pytest.mark.parametrize("cut", [1, 7, 30, 1000])
def test_whole_elements_leave_in_batches(cut):
    doc = {"images": [{"id": i, "t": "}{" * (i % 3)} for i in range(40)], "annotations": [{"a": {"b": [i]}} for i in range(9)]}
    text = json.dumps(doc).encode()
    split, rows, whole = _Split("f", 0, 0, 0), [], []
    for i in range(0, len(text), cut):
        r, w = split.feed(text[i : i + cut])
        rows, whole = rows + r, whole + w
    rows += split.finish()
    found = [(run, n, json.loads(t)) for _, _, run, _, n, _, _, t in rows if n >= 0]
    found += [(x["run"], x["n"], json.loads(x["text"])) for b in whole for x in b.to_pylist()]
    assert sorted((r, n) for r, n, _ in found) == [(1, n) for n in range(40)] + [(2, n) for n in range(9)]
    assert all(e == doc["images" if r == 1 else "annotations"][n] for r, n, e in found)
    if cut == 1000:
        assert len(whole) <= 4
