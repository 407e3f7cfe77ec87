"""The parallel reader of JSON arrays against json.loads and the plain reader,
on documents cut into many file splits."""

import json
import random

import pytest

from vantage.operators.checks import CheckFailed
from vantage.sources import coco
from vantage.sources.json_arrays import read_sections


@pytest.fixture()
def tiny_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def awkward(seed):
    """Strings full of brackets, quotes and backslashes; nested arrays and
    objects; elements longer than a split; other sections in between."""
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(["a", "}", "{", "[", "]", '"', "\\", "é", "\n", ",", ":", "𝄞", '\\"']) for _ in range(rng.randint(0, 9)))
    return {
        "info": {"a": {"b": [1, {"c": "}"}]}, "d": None},
        "images": [{"id": i, "file_name": text(), "width": 1.5, "height": None, "x}y": {"k": [{"z": text()}]}} for i in range(30)],
        "licenses": [{"id": 1, "n": [[{"a": 2}]]}],
        "annotations": [{"id": i, "image_id": i % 30, "category_id": 1, "bbox": [1, 2.5, i, 4], "seg": {"counts": [7] * rng.choice([0, 3, 2500])}, "t": text()}
                        for i in range(40)],
        "numbers": [1, 2, 3],
        "deep": [[1, [2]], [{"q": 1}]],
    }


DUMPS = [lambda d: json.dumps(d), lambda d: json.dumps(d, indent=1, ensure_ascii=False), lambda d: "﻿" + json.dumps(d) + " \n\n"]


@pytest.mark.parametrize("kind", range(len(DUMPS)))
def test_elements_equal_json_loads(spark, tmp_dir, tiny_splits, kind):
    doc = awkward(kind)
    path = f"{tmp_dir}/d.json"
    with open(path, "w", encoding="utf-8") as f:
        f.write(DUMPS[kind](doc))
    assert coco.read_coco_document(spark, path).rdd.getNumPartitions() == 1
    rows = read_sections(spark, path, {"images": True, "annotations": True, "licenses": False, "absent": False}, coco._kept).collect()
    for section in ("images", "annotations", "licenses"):
        mine = sorted((r for r in rows if r.section == section), key=lambda r: r.pos)
        assert [r.pos for r in mine] == list(range(len(doc[section])))
        assert [json.loads(r.text, strict=False) for r in mine] == doc[section]


def test_tables_equal_the_plain_reader(spark, tmp_dir, tiny_splits):
    for name, seed in (("b", 5), ("a", 6)):  # two documents of one split
        with open(f"{tmp_dir}/{name}.json", "w", encoding="utf-8") as f:
            json.dump(awkward(seed), f)
    got = coco.read_coco_splits(spark, {"train": tmp_dir})
    want = coco.raw_tables(coco.read_coco_document(spark, tmp_dir), "train")
    for g, w in zip(got, want):
        assert g.columns == w.columns
        assert sorted(map(repr, g.collect())) == sorted(map(repr, w.collect()))


BAD = {
    "cut short": lambda t: t[:-1],
    "cut in an element": lambda t: t[: len(t) // 2],
    "no comma": lambda t: t.replace("}, {", "} {", 1),
    "two commas": lambda t: t.replace("}, {", "},, {", 1),
    "wrong bracket": lambda t: t[:-1] + "]",
    "something behind": lambda t: t + " 7",
    "a broken element": lambda t: t.replace('"id": 3', '"id" 3', 1),
    "an array as element": lambda t: t.replace('"images": [', '"images": [[1], ', 1),
    "a number as element": lambda t: t.replace('"images": [', '"images": [1, ', 1),
    "no images": lambda t: t.replace('"images"', '"pictures"', 1),
    "images null": lambda t: json.dumps({"images": None, "annotations": []}),
    "images twice": lambda t: t.replace('"licenses"', '"images"', 1),
    "no object": lambda t: "[1]",
    "nothing": lambda t: " ",
}


@pytest.mark.parametrize("fault", BAD)
def test_broken_documents_are_errors(spark, tmp_dir, tiny_splits, fault):
    path = f"{tmp_dir}/d.json"
    with open(path, "w", encoding="utf-8") as f:
        f.write(BAD[fault](json.dumps({"images": [{"id": i} for i in range(5)], "licenses": [{}], "annotations": []})))
    with pytest.raises(Exception):
        coco.read_coco_splits(spark, {"train": path})


def test_staging_counts_on_the_way_and_is_whole_or_nothing(spark, tmp_dir):
    good = {"images": [{"id": 1, "file_name": "a.png"}], "annotations": [{"id": 1, "image_id": 1, "bbox": [1, 2, 3, 4]}, {"id": 2, "image_id": 1}]}
    bad = {**good, "annotations": [{"id": 1, "image_id": 1, "bbox": [1, 2, 3]}, {"id": 2, "bbox": [1, 2, 3, "x"]}]}
    for name, doc in (("good", good), ("bad", bad)):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            json.dump(doc, f)
    assert coco.stage_coco(spark, {"train": f"{tmp_dir}/good.json"}, f"{tmp_dir}/t", strict=True) == {"images": 1, "annotations": 2, "categories": 0}
    assert coco.read_staged(spark, f"{tmp_dir}/t")[1].count() == 2
    with pytest.raises(CheckFailed, match="'a box is not a list of four numbers': 2"):
        coco.stage_coco(spark, {"train": f"{tmp_dir}/bad.json"}, f"{tmp_dir}/t", strict=True)
    with pytest.raises(ValueError, match="did not end"):
        coco.read_staged(spark, f"{tmp_dir}/t")


@pytest.mark.parametrize("end", ["", "\n"])
def test_packed_documents(spark, tmp_dir, end):
    import gzip

    doc = awkward(9)
    with gzip.open(f"{tmp_dir}/d.json.gz", "wt", encoding="utf-8") as f:
        f.write(json.dumps(doc) + end)
    images, annotations, _ = coco.read_coco_splits(spark, {"train": f"{tmp_dir}/d.json.gz"})
    assert images.count() == len(doc["images"]) and annotations.count() == len(doc["annotations"])
    with gzip.open(f"{tmp_dir}/broken.json.gz", "wt", encoding="utf-8") as f:
        f.write(json.dumps(doc)[:-20])
    with pytest.raises(CheckFailed):
        coco.read_coco_splits(spark, {"train": f"{tmp_dir}/broken.json.gz"})
