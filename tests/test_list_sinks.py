"""Lists of any length as JSON lines and CSV: pieces parse like the whole."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from vantage.operators import mapping_index as MI
from vantage.sources import sinks


def rows_of(path):
    out = []
    for p in sorted(glob.glob(f"{path}/part-*")):
        with open(p, encoding="utf-8") as f:
            out.append([json.loads(line) for line in f if line.strip()])
    return out


@pytest.fixture()
def mapping(spark):
    odd = ['a"b', "c,d", "e\\f", "é𝄞", "", " x", "]", "[", "{", "}"]
    rows = [(str(k), 7, k) for k in range(25)] + [(t, 8, 100 + k) for k, t in enumerate(odd)] + [("1", 9, 200), ("1", 9, 201), ("z", -3, 300)]
    return spark.createDataFrame(rows, "image_id string, viewpoint_id long, seq long").repartition(5)


@pytest.mark.parametrize("chunk", [1, 3, 10, 1000])
def test_grouped_lists(spark, tmp_dir, mapping, chunk):
    want = {r.viewpoint_id: (r.image_count, r.image_ids) for r in MI.grouped_mapping(mapping).collect()}
    sinks.write_grouped(MI.mapping_ranks(mapping), MI.viewpoint_sizes(mapping), tmp_dir, chunk)
    files = rows_of(f"{tmp_dir}/viewpoint_to_images_jsonl")
    flat = [r for f in files for r in f]
    assert [r["viewpoint_id"] for r in flat] == [-3, 7, 8, 9]  # in order over the files
    assert {r["viewpoint_id"]: (r["image_count"], r["image_ids"]) for r in flat} == want
    again = spark.read.schema("viewpoint_id long, image_count long, image_ids array<string>").json(f"{tmp_dir}/viewpoint_to_images_jsonl")
    assert {r.viewpoint_id: (r.image_count, r.image_ids) for r in again.where("viewpoint_id is not null").collect()} == want
    csv = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(f"{tmp_dir}/viewpoint_to_images_csv")
    assert csv.columns == ["viewpoint_id", "image_count", "image_ids_json"]
    assert {int(r.viewpoint_id): (int(r.image_count), json.loads(r.image_ids_json)) for r in csv.collect()} == want


@pytest.mark.parametrize("chunk", [2, 1000])
def test_bucket_files_keep_empty_buckets(spark, tmp_dir, mapping, chunk):
    assignment = MI.bucket_assignment(mapping, 6)
    sinks.write_bucket_files(assignment, MI.bucket_totals(assignment, 6), MI.bucket_members(assignment), tmp_dir, chunk)
    want = {r.bucket_id: (r.viewpoint_count, r.image_count, r.viewpoint_ids) for r in MI.bucket_summary(assignment, 6).collect()}
    csv = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(f"{tmp_dir}/bucket_summary")
    got = {int(r.bucket_id): (int(r.viewpoint_count), int(r.image_count), json.loads(r.viewpoint_ids_json)) for r in csv.collect()}
    assert got == want and len(want) == 6 and (0, 0, []) in want.values()


def test_no_row_holds_a_long_list(spark, mapping):
    pieces = sinks.list_pieces(MI.mapping_ranks(mapping), "viewpoint_id", "image_id", 4)
    assert pieces.select(F.max(F.size(F.split("body", ",")))).first()[0] <= 5  # one value holds a comma
    assert pieces.where("viewpoint_id = 7").count() == 7
