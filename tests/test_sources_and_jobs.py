"""Sources, sinks and the spark-submit jobs on small files."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.test_metrics_fixture import COCO, MAPPING
from vantage.operators import dataset_index as X
from vantage.operators import insight as I
from vantage.operators import review as R
from vantage.operators.checks import CheckFailed
from vantage.operators.normalize import normalize_annotations, normalize_categories, normalize_images
from vantage.plans import job
from vantage.sources import files, registry
from vantage.sources.coco import read_coco_splits
from vantage.sources.registry import save_registry
from vantage.sources.mapping import MappingSchemaError, read_mapping_csv, read_mapping_strict, read_mapping_trimmed


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def read_json_lines(pattern):
    out = []
    for p in sorted(glob.glob(pattern)):
        with open(p) as f:
            out += [json.loads(line) for line in f if line.strip()]
    return out


def test_metrics_job_end_to_end(spark, tmp_dir):
    train = write(f"{tmp_dir}/train.json", json.dumps(COCO))
    val = write(f"{tmp_dir}/val.json", json.dumps({"images": [], "annotations": [], "categories": []}))
    mapping = write(f"{tmp_dir}/mapping.csv", MAPPING)
    out = f"{tmp_dir}/out"
    facts = job.main(["metrics", "--mapping-csv", mapping, "--train-json", train, "--val-json", val,
                      "--output-dir", out, "--preview-jsonl", f"{tmp_dir}/preview", "--preview-limit", "1",
                      "--shuffle-partitions", "8"])
    assert facts["mapping_rows"] == 5 and facts["joined_rows"] == 7
    assert facts["images_rows"] == 3 and facts["viewpoints_rows"] == 2
    rows = spark.read.parquet(out).collect()
    assert [r.viewpoint_id for r in rows] == [7, 8]
    preview = read_json_lines(f"{tmp_dir}/preview/*.json")
    assert len(preview) == 1 and preview[0]["viewpoint_id"] == 7
    manifest = {r["fact"]: r["value"] for r in read_json_lines(f"{out}_manifest/*.json")}
    assert manifest["joined_rows"] == "7"


def test_mapping_index_and_smoke_jobs(spark, tmp_dir):
    text = "image_id,viewpoint_id,extra\n" + "".join(f" {i} , {i % 5} ,x\n" for i in range(40))
    src = write(f"{tmp_dir}/m.csv", text)
    facts = job.main(["mapping-index", "--input-csv", src, "--output-dir", f"{tmp_dir}/idx",
                      "--num-node-buckets", "3", "--shuffle-partitions", "8"])
    assert facts == {"rows": 40, "viewpoints": 5, "buckets": 3}
    grouped = read_json_lines(f"{tmp_dir}/idx/viewpoint_to_images_jsonl/part-*")
    assert grouped[0]["viewpoint_id"] == 0 and grouped[0]["image_ids"] == [str(i) for i in range(0, 40, 5)]
    summary = spark.read.option("header", "true").csv(f"{tmp_dir}/idx/bucket_summary").collect()
    assert sorted(int(r.viewpoint_count) for r in summary) == [1, 2, 2]
    job.main(["smoke", "--input-csv", src, "--output-csv", f"{tmp_dir}/smoke", "--max-viewpoints", "2",
              "--max-images", "5", "--shuffle-partitions", "8"])
    smoke = read_mapping_csv(spark, f"{tmp_dir}/smoke").orderBy("seq").collect()
    assert [(r.image_id, r.viewpoint_id) for r in smoke] == [("0", 0), ("1", 1), ("5", 0), ("6", 1), ("10", 0)]


def test_mapping_sources(spark, tmp_dir):
    p = write(f"{tmp_dir}/a.csv", 'image_id,viewpoint_id\n"a,""b""",1\nc,x\n,3\nd,4\n')
    rows = read_mapping_csv(spark, p).orderBy("seq").collect()
    assert [(r.image_id, r.viewpoint_id, r.seq) for r in rows] == [('a,"b"', 1, 0), ("d", 4, 3)]
    with pytest.raises(MappingSchemaError):
        read_mapping_strict(spark, write(f"{tmp_dir}/b.csv", "viewpoint_id,image_id\n1,a\n"))
    assert read_mapping_strict(spark, f"{tmp_dir}/missing.csv", missing_ok=True).count() == 0
    with pytest.raises(FileNotFoundError):
        read_mapping_strict(spark, f"{tmp_dir}/missing.csv")
    with pytest.raises(Exception):
        read_mapping_trimmed(spark, write(f"{tmp_dir}/c.csv", "image_id,viewpoint_id\na, x\n")).collect()


def test_file_order_across_files(spark, tmp_dir):
    write(f"{tmp_dir}/m/a.csv", "image_id,viewpoint_id\n" + "".join(f"a{i},1\n" for i in range(3)))
    write(f"{tmp_dir}/m/b.csv", "image_id,viewpoint_id\n" + "".join(f"b{i},2\n" for i in range(2000)))
    rows = read_mapping_csv(spark, f"{tmp_dir}/m").orderBy("seq").collect()
    assert [r.image_id for r in rows[:4]] == ["a0", "a1", "a2", "b0"]
    assert [r.seq for r in rows] == list(range(2003))


def test_metrics_jsonl(spark, tmp_dir):
    p = write(f"{tmp_dir}/m.jsonl", '{"viewpoint_id": 1, "total_images": "3", "entropy": "bad"}\n\n'
                                     '{"viewpoint_id": 2, "class_distribution_vector": null}\n')
    rows = I.read_metrics_jsonl(spark, p).orderBy("viewpoint_id").collect()
    assert rows[0].total_images == 3 and rows[0].entropy is None
    assert rows[1].class_distribution_vector == "{}"
    with pytest.raises(Exception):
        I.read_metrics_jsonl(spark, write(f"{tmp_dir}/bad.jsonl", '{"viewpoint_id": 1}\n{oops\n')).collect()
    with pytest.raises(ValueError):
        I.read_metrics_jsonl(spark, write(f"{tmp_dir}/empty.jsonl", "\n\n"))


def test_pair_csv_roundtrip_and_review(spark, tmp_dir):
    header = ",".join(["viewpoint_id_a", "image_id_a", "image_path_a", "viewpoint_id_b", "image_id_b",
                       "image_path_b", "centroid_similarity", "merge_decision", "notes"])
    body = "\n".join([
        r"3,img3,C:\data\img3.png,9,img9,C:\data\img9.png,0.982821,,",
        r"1,img1,C:\data\img1.png,4,img4,C:\data\img4.png,0.970019,merge,looks same",
    ])
    src = write(f"{tmp_dir}/pairs.csv", header + "\n" + body + "\n")
    rows = R.read_pair_csv(spark, src)
    got = rows.orderBy("seq").collect()
    assert got[0].image_path_a == r"C:\data\img3.png" and got[0].merge_decision == ""
    assert got[1].merge_decision == "merge" and got[1].centroid_similarity == pytest.approx(0.970019)
    R.write_pair_csv(rows.drop("seq"), f"{tmp_dir}/out")
    back = R.read_pair_csv(spark, f"{tmp_dir}/out").orderBy("seq").collect()
    assert [(r.viewpoint_id_a, r.notes) for r in back] == [(3, ""), (1, "looks same")]
    progress = R.review_progress(rows).first()
    assert (progress.total, progress.merge, progress.undecided, progress.resume_index) == (2, 1, 1, 0)
    with pytest.raises(R.ReviewFileError):
        R.read_pair_csv(spark, write(f"{tmp_dir}/bad.csv", "a,b\n1,2\n"))
    aligned = R.check_alignment(rows, rows.withColumn(
        "viewpoint_id_b", F.when(F.col("seq") == 1, F.lit(5)).otherwise(F.col("viewpoint_id_b"))))
    assert [r.problem for r in aligned.collect()] == ["viewpoint_id_b mismatch"]


def test_image_listing(spark, tmp_dir):
    for name in ["train/data/1.png", "train/data/sub/2.png", "val/data/3.png", "val/data/notes.txt"]:
        write(f"{tmp_dir}/{name}", "x")
    got = {r.image_id for r in files.image_path_map(spark, [f"{tmp_dir}/train", f"{tmp_dir}/val"]).collect()}
    assert got == {"1", "2", "3"}
    write(f"{tmp_dir}/val/data/again/1.png", "x")
    with pytest.raises(ValueError):
        files.image_path_map(spark, [f"{tmp_dir}/train", f"{tmp_dir}/val"])


def test_folders_walked_in_tasks_equal_the_file_index(spark, tmp_dir):
    names = ["a/1.png", "a/b/2.png", "a/b/c/d/3.png", "4.png", "a/5.PNG", "a/b/6.jpg", "_x/7.png", ".h/8.png", "a/_9.png", "a b/ü 10.png", "a/b[1].png"]
    for name in names:
        write(f"{tmp_dir}/imgs/{name}", "x")
    for pattern in ("*.png", "?.png", "[0-9].*", "*", "b?1?.png"):
        walked = sorted(map(tuple, files.list_images(spark, f"file://{tmp_dir}/imgs", pattern).collect()))
        indexed = files.indexed(spark, f"{tmp_dir}/imgs", pattern)
        hidden = indexed.where("path not like '%/\\\\_%' and path not like '%/.%'")
        assert sorted(p for _, p in walked) == sorted(r.path for r in hidden.collect()), pattern
    assert files._opens_in_tasks(f"file://{tmp_dir}") and not files._opens_in_tasks(tmp_dir) and not files._opens_in_tasks("viewfs://x/y")
    with pytest.raises(ValueError):
        write(f"{tmp_dir}/imgs/z/1.png", "x")
        files.image_path_map(spark, [f"file://{tmp_dir}/imgs"])


def test_registry_save_load(spark, tmp_dir):
    reg = spark.createDataFrame([(0, [3.0, 4.0], 2), (1, [0.0, 2.0], 1)], "viewpoint_id long, centroid array<double>, count long")
    registry.save_registry(reg, f"{tmp_dir}/r", 3)
    loaded, last = registry.load_registry(spark, f"{tmp_dir}/r", dim=2)
    assert last == 3
    assert {r.viewpoint_id: r.centroid for r in loaded.collect()}[0] == pytest.approx([0.6, 0.8])
    assert registry.registry_totals(loaded).first().asDict() == {"viewpoints": 2, "images": 3}
    with pytest.raises(ValueError):
        registry.load_registry(spark, f"{tmp_dir}/r", dim=3)
    empty, last = registry.load_registry(spark, f"{tmp_dir}/none", dim=2)
    assert last == 0 and empty.count() == 0


def test_stage_coco_to_parquet(spark, tmp_dir):
    from vantage.sources.coco import stage_coco

    train = write(f"{tmp_dir}/train.json", json.dumps(COCO))
    val = write(f"{tmp_dir}/val.json", json.dumps({"images": [{"id": 1, "file_name": "v.png", "width": 1,
                                                               "height": 1}], "annotations": [], "categories": []}))
    stage_coco(spark, {"train": train, "val": val}, f"{tmp_dir}/staged", partitions=3)
    images = spark.read.parquet(f"{tmp_dir}/staged/images")
    assert images.count() == 6 and images.where("split = 'val'").count() == 1
    anns = spark.read.parquet(f"{tmp_dir}/staged/annotations")
    assert anns.count() == 9 and anns.where("area is null").count() == 3
    assert spark.read.parquet(f"{tmp_dir}/staged/categories").count() == 4


def test_review_and_insight_jobs(spark, tmp_dir):
    header = ",".join(["viewpoint_id_a", "image_id_a", "image_path_a", "viewpoint_id_b", "image_id_b",
                       "image_path_b", "centroid_similarity", "merge_decision", "notes"])
    cands = write(f"{tmp_dir}/c.csv", header + "\n1,a,p,2,b,q,0.99,,\n3,c,r,4,d,s,0.98,,\n")
    decs = write(f"{tmp_dir}/d.csv", header + "\n1,a,p,2,b,q,0.99,merge,\n3,c,r,4,d,s,0.98,,\n")
    facts = job.main(["review", "--candidates-csv", cands, "--decisions-csv", decs, "--shuffle-partitions", "8"])
    assert (facts["merge"], facts["undecided"], facts["resume_index"]) == (1, 1, 1)
    bad = write(f"{tmp_dir}/bad.csv", header + "\n1,a,p,9,b,q,0.99,merge,\n3,c,r,4,d,s,0.98,,\n")
    with pytest.raises(Exception):
        job.main(["review", "--candidates-csv", cands, "--decisions-csv", bad, "--shuffle-partitions", "8"])

    metrics = write(f"{tmp_dir}/m.jsonl", "".join(json.dumps({
        "viewpoint_id": v, "total_images": v, "total_vehicles": 10 * v, "avg_vehicle_count": 1.0,
        "per_vehicle_count": 1.0, "avg_bbox_density": 0.1, "heavy_vehicle_ratio": 0.0, "two_wheeler_ratio": 0.0,
        "entropy": 1.0, "congestion_index": 0.1 * v, "class_distribution_vector": '{"car":1.0}'}) + "\n"
        for v in range(1, 6)))
    facts = job.main(["insight", "--metrics", metrics, "--output-dir", f"{tmp_dir}/ins", "--min-images", "2",
                      "--top-n", "2", "--bins", "4", "--shuffle-partitions", "8"])
    assert facts == {"viewpoints": 4, "total_vehicles": 140}
    top = [r.viewpoint_id for r in spark.read.parquet(f"{tmp_dir}/ins/top_congestion").collect()]
    assert sorted(top) == [4, 5]
    assert spark.read.parquet(f"{tmp_dir}/ins/viewpoint_detail").first().viewpoint_id == 2
    assert [r.class_name for r in spark.read.parquet(f"{tmp_dir}/ins/viewpoint_classes").collect()] == ["car"]


def test_near_duplicates_job(spark, tmp_dir):
    reg = spark.createDataFrame(
        [(0, [1.0, 0.0, 0.0], 2), (1, [0.99, 0.05, 0.0], 1), (2, [0.0, 1.0, 0.0], 1), (3, [0.0, 0.0, 1.0], 1)],
        "viewpoint_id long, centroid array<double>, count long")
    save_registry(reg, f"{tmp_dir}/registry", 5)
    mapping = write(f"{tmp_dir}/m.csv", "image_id,viewpoint_id\nimg0,0\nimg0b,0\nimg1,1\nimg2,2\nimg3,3\n")
    for name in ["img0", "img0b", "img1", "img2", "img3"]:
        write(f"{tmp_dir}/imgs/data/{name}.png", "x")
    facts = job.main(["near-duplicates", "--registry", f"{tmp_dir}/registry", "--mapping-csv", mapping,
                      "--images-dir", f"{tmp_dir}/imgs", "--output-csv", f"{tmp_dir}/pairs", "--dim", "3",
                      "--shuffle-partitions", "8"])
    assert facts == {"pairs": 1, "left_out": 0}
    rows = R.read_pair_csv(spark, f"{tmp_dir}/pairs").collect()
    assert [(r.viewpoint_id_a, r.image_id_a, r.viewpoint_id_b, r.image_id_b) for r in rows] == [(0, "img0", 1, "img1")]
    text = open(glob.glob(f"{tmp_dir}/pairs/*.csv")[0]).read().splitlines()
    assert text[1].split(",")[6] == "0.998727" and text[1].endswith(",,")


def test_metrics_from_staged_tables_equal_the_documents(spark, tmp_dir):
    train = write(f"{tmp_dir}/train.json", json.dumps(COCO))
    val = write(f"{tmp_dir}/val.json", json.dumps({"images": [], "annotations": [], "categories": []}))
    mapping = write(f"{tmp_dir}/m.csv", "image_id,viewpoint_id\n101,7.0\n102,7\n103.v2,8\n104,8\n105,x\n999,8\n")
    boxes = dict(COCO, annotations=[a for a in COCO["annotations"] if len(a.get("bbox") or [0] * 4) == 4])
    ok = write(f"{tmp_dir}/ok.json", json.dumps(boxes))
    common = ["--mapping-csv", mapping, "--shuffle-partitions", "8"]
    job.main(["metrics", "--train-json", ok, "--val-json", val, "--output-dir", f"{tmp_dir}/a", *common])
    job.main(["stage", "--train-json", ok, "--val-json", val, "--output-dir", f"{tmp_dir}/t", "--shuffle-partitions", "8"])
    job.main(["metrics", "--tables", f"{tmp_dir}/t", "--output-dir", f"{tmp_dir}/b", *common])
    one, two = (sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/{x}").collect())) for x in "ab")
    assert one == two and {r[0] for r in one} == {7, 8}
    with pytest.raises(CheckFailed):  # a box of three numbers
        job.main(["stage", "--train-json", train, "--val-json", val, "--output-dir", f"{tmp_dir}/u", "--shuffle-partitions", "8"])


def test_coco_ids_as_text_and_broken_documents(spark, tmp_dir):
    text = {"images": [{"id": "10", "file_name": "a.png", "width": "4", "height": 2}],
            "annotations": [{"id": "1", "image_id": "10", "category_id": "3", "bbox": ["0", 0, 2, 2]}],
            "categories": [{"id": "3", "name": "Car"}]}
    path = write(f"{tmp_dir}/t.json", json.dumps(text))
    images, anns, cats = read_coco_splits(spark, {"train": path})
    assert normalize_images(images).first().coco_image_id == 10
    a = normalize_annotations(anns).first()
    assert (a.annotation_id, a.coco_image_id, a.category_id, a.bbox_area) == (1, 10, 3, 4.0)
    assert normalize_categories(cats).first().category_id == 3
    broken = write(f"{tmp_dir}/b.json", json.dumps(text)[:-30])
    with pytest.raises(Exception):
        read_coco_splits(spark, {"train": broken})
    empty = write(f"{tmp_dir}/e.json", json.dumps({"images": []}))
    with pytest.raises(CheckFailed):
        read_coco_splits(spark, {"train": empty})


def test_several_documents_of_a_split_follow_each_other(spark, tmp_dir):
    for k, ids in (("b", [3, 4]), ("a", [1, 2])):
        images = [{"id": i, "file_name": f"{i}.png", "width": 1, "height": 1} for i in ids]
        write(f"{tmp_dir}/docs/{k}.json", json.dumps({"images": images, "annotations": [], "categories": []}))
    images, _, _ = read_coco_splits(spark, {"train": f"{tmp_dir}/docs"})
    index = X.ordered_index(normalize_images(images)).orderBy("seq").collect()
    assert [(r.seq, r.coco_image_id) for r in index] == [(0, 1), (1, 2), (2, 3), (3, 4)]


def test_boxes_must_be_four_numbers(spark):
    images = spark.createDataFrame([("train", 7, "t", 9.0, 9.0)], "split string, coco_image_id long, image_id string, width double, height double")
    anns = spark.createDataFrame([("train", 0, 7, 1, [1.0, 1.0, 1.0])],
                                 "split string, pos long, coco_image_id long, annotation_id long, bbox array<double>")
    for make in (X.image_bboxes, X.mask_rects):
        with pytest.raises(CheckFailed):
            make(images, anns)


def test_decide_job_keeps_the_candidate_order(spark, tmp_dir):
    header = ",".join(["viewpoint_id_a", "image_id_a", "image_path_a", "viewpoint_id_b", "image_id_b",
                       "image_path_b", "centroid_similarity", "merge_decision", "notes"])
    # rows 2 and 3 have one similarity at six digits and are not in id order
    lines = ["1,a,p,2,b,q,0.990000,,", "7,e,t,8,f,u,0.980000,,", "3,c,r,4,d,s,0.980000,,"]
    cands = write(f"{tmp_dir}/c.csv", header + "\n" + "\n".join(lines) + "\n")
    events = write(f"{tmp_dir}/e.csv", "viewpoint_id_a,viewpoint_id_b,merge_decision,notes\n3,4,merge,\n3,4,no_merge,look again\n")
    facts = job.main(["decide", "--candidates-csv", cands, "--events-csv", events, "--output-csv", f"{tmp_dir}/d",
                      "--shuffle-partitions", "8"])
    assert (facts["no_merge"], facts["undecided"]) == (1, 2)
    got = R.read_pair_csv(spark, f"{tmp_dir}/d").orderBy("seq").collect()
    assert [(r.viewpoint_id_a, r.merge_decision, r.notes) for r in got] == [(1, "", ""), (7, "", ""), (3, "no_merge", "look again")]
    check = job.main(["review", "--candidates-csv", cands, "--decisions-csv", f"{tmp_dir}/d", "--shuffle-partitions", "8"])
    assert check["no_merge"] == 1


def test_paths_must_match_in_strict_mode(spark):
    files = spark.createDataFrame([("r/data/a.png",), ("r/data/x/a.png",)], "path string")
    with pytest.raises(CheckFailed):
        X.split_path_lookup(files, {"train": "r"})
    look = X.split_path_lookup(files.limit(1), {"train": "r"})
    index = spark.createDataFrame([("test", "a.png")], "split string, file_name string")
    with pytest.raises(CheckFailed):
        X.resolve_paths(index, look)


def test_checkpoint_folder_must_be_shared(monkeypatch):
    from types import SimpleNamespace

    from vantage.session import checkpoint_root

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(RuntimeError):
        checkpoint_root(fake)


def test_mapping_csv_round_trip_keeps_order_across_part_files(spark, tmp_dir):
    from vantage.sources.sinks import write_mapping_csv

    rows = [(f"im{(i * 7919) % 1000}", i % 13, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "image_id string, viewpoint_id long, seq long").repartition(6)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")  # several part files, as a large mapping would give
    try:
        write_mapping_csv(df, f"{tmp_dir}/mapping")
    finally:
        spark.conf.set(key, before)
    assert len(glob.glob(f"{tmp_dir}/mapping/part-*.csv")) > 1
    back = read_mapping_csv(spark, f"{tmp_dir}/mapping").orderBy("seq").collect()
    assert [(r.image_id, r.viewpoint_id, r.seq) for r in back] == rows


def test_a_job_empties_its_scratch_tables(spark, tmp_dir):
    from vantage import session

    kept = session.scratch_path(spark, "kept")
    spark.range(5).write.parquet(kept)
    session._SCRATCH.remove(kept)  # another run's
    text = "image_id,viewpoint_id\n" + "".join(f"{i},{i % 5}\n" for i in range(40))
    src = write(f"{tmp_dir}/m.csv", text)
    job.main(["mapping-index", "--input-csv", src, "--output-dir", f"{tmp_dir}/idx", "--num-node-buckets", "3", "--shuffle-partitions", "8"])
    assert session._SCRATCH == [] and spark.read.parquet(kept).count() == 5
    steps = read_json_lines(f"{tmp_dir}/idx/_manifest_steps/part-*")
    assert [s["step"] for s in sorted(steps, key=lambda s: s["seconds"])] == ["mapping", "viewpoints", "grouped", "assignment", "buckets"]
    job.main(["mapping-index", "--input-csv", src, "--output-dir", f"{tmp_dir}/idx", "--num-node-buckets", "3", "--shuffle-partitions", "8"])
    steps = read_json_lines(f"{tmp_dir}/idx/_manifest_steps/part-*")
    assert len(steps) == 10 and len({s["attempt"] for s in steps}) == 2  # a rerun is told apart
