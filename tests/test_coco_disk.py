"""What a COCO round trip leaves on disk on the way: documents, text and parsed
elements go when the next form of them is written, shuffle files with the write."""

import glob
import json
import time

from conftest import SF_SMALL
from vantage import session
from vantage.plans import round_trips
from vantage.sources import coco, sinks


def documents(tmp_dir):
    for name, first in (("train", 0), ("val", 100)):
        doc = {"images": [{"id": i, "file_name": f"{i}.png"} for i in range(first, first + 30)],
               "annotations": [{"id": i, "image_id": i % 30 + first, "bbox": [1, 2, 3, 4]} for i in range(70)]}
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            json.dump(doc, f)
    return {name: f"{tmp_dir}/{name}.json" for name in ("train", "val")}


def asked_for(monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", [])
    return lambda: sorted(path.rsplit("/", 1)[1][:-13] for path in session._SCRATCH)


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return sum("/shuffle_" in f for f in found.split("\n"))


def drops_to(spark, n):
    """Whether the shuffle files become ``n``: executors drop them on their own time."""
    for _ in range(100):
        if shuffle_files(spark) <= n:
            return True
        time.sleep(0.1)
    return False


def test_text_goes_when_it_is_parsed(spark, tmp_dir, monkeypatch):
    held = asked_for(monkeypatch)
    images, annotations, _ = coco.read_coco_splits(spark, documents(tmp_dir))
    assert held() == ["coco-elements"] * 2
    for _ in range(2):  # the result reads what is left, and not the documents
        assert images.count() == 60 and annotations.count() == 140
        sinks.write_table(spark.range(0), f"{tmp_dir}/train.json")


def test_elements_go_when_they_are_staged(spark, tmp_dir, monkeypatch):
    held = asked_for(monkeypatch)
    facts = coco.stage_coco(spark, documents(tmp_dir), f"{tmp_dir}/t", strict=True)
    assert held() == [] and facts == {"images": 60, "annotations": 140, "categories": 0}
    assert [t.count() for t in coco.read_staged(spark, f"{tmp_dir}/t")] == [60, 140, 0]
    assert len(glob.glob(f"{tmp_dir}/*.json")) == 2  # documents of the caller stay


def test_documents_of_one_split_at_a_time(spark, monkeypatch):
    held = asked_for(monkeypatch)
    text = lambda path: sum(r["value"].count('"image_id"') for r in spark.read.text(path).collect()) if held() else 0
    found, last = {}, None
    for name, path in round_trips.coco_documents(spark, SF_SMALL):
        if last:
            assert spark.read.parquet(last).count() == 0
        found[name], last = text(path), path
        assert held() == ["coco-annotations", f"coco-{name}"]
    assert list(found) == ["train", "val"] and sum(found.values()) == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert held() == []


def test_a_write_drops_its_shuffle_files(spark, tmp_dir):
    before = spark.conf.get(session.FREE_SHUFFLES, "false")
    rows = spark.range(5000).repartition(3, "id")
    rows.write.parquet(f"{tmp_dir}/a")
    held = shuffle_files(spark)
    with session.shuffles_freed(spark):
        rows.write.parquet(f"{tmp_dir}/b")
    assert 0 < held and drops_to(spark, held)
    one = spark.range(60).selectExpr("id as pos", "id")
    sinks.write_coco(one, spark.range(300).selectExpr("id as pos", "id", "id % 60 as image_id"), one, f"{tmp_dir}/d", 3)
    assert drops_to(spark, held)
    assert spark.conf.get(session.FREE_SHUFFLES, "false") == before
    assert spark.read.parquet(f"{tmp_dir}/b").count() == 5000 and rows.count() == 5000
