"""Plan shape: the flagship reads each table once, prunes columns, stays in
the JVM; smaller operators behave at their edges."""

import contextlib
import io
import json
import os


from tests.conftest import SF_SMALL
from vantage.operators import dataset_index as X
from vantage.operators import review as R
from vantage.operators.checks import check_unmatched
from vantage.plans import catalog as CAT
from vantage.operators import metrics as M
from vantage.sources.coco import check_required_sections, read_coco_document


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_flagship_scans_each_table_once_and_prunes(spark):
    text = plan_text(M.viewpoint_metrics(CAT.traffic_inputs(spark, SF_SMALL)))
    scans = [line for line in text.splitlines() if line.startswith("Location:")]
    assert sum("lineitem.parquet" in s for s in scans) == 1
    assert sum("part.parquet" in s for s in scans) == 1
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema:") and "l_orderkey" in line][0]
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text
    assert "Expand" in text  # the grouping-sets aggregate feeds both branches


def test_split_lookup_and_path_resolution(spark):
    files = spark.createDataFrame([("split-a/data/a.png",), ("split-a/data/x/b.png",), ("split-b/data/a.png",),
                                   ("split-b/other/c.png",)], "path string")
    look = X.split_path_lookup(files, {"train": "split-a", "val": "split-b"})
    got = sorted((r.split, r.basename) for r in look.collect())
    assert got == [("train", "a.png"), ("train", "b.png"), ("val", "a.png")]
    index = spark.createDataFrame([("train", "a.png"), ("val", "a.png"), ("val", "c.png")], "split string, file_name string")
    resolved = {(r.split, r.file_name): r.path for r in X.resolve_paths(index, look, strict=False).collect()}
    assert resolved[("val", "a.png")] == "split-b/data/a.png" and resolved[("val", "c.png")] is None
    missing = check_unmatched(index, look.withColumnRenamed("basename", "file_name"), ["split", "file_name"])
    assert [(r.split, r.file_name) for r in missing.collect()] == [("val", "c.png")]


def test_latest_decision_wins(spark):
    cands = spark.createDataFrame([(1, 2, 0.99, "", ""), (3, 4, 0.98, "", "")],
                                  "viewpoint_id_a long, viewpoint_id_b long, centroid_similarity double, "
                                  "merge_decision string, notes string")
    events = spark.createDataFrame([(1, 2, "merge", "", 0), (1, 2, "no_merge", "second look", 1)],
                                   "viewpoint_id_a long, viewpoint_id_b long, merge_decision string, notes string, "
                                   "event_seq long")
    out = R.with_candidate_order(R.apply_decisions(cands, events))
    rows = {r.viewpoint_id_a: r for r in out.collect()}
    assert (rows[1].merge_decision, rows[1].notes, rows[3].merge_decision) == ("no_merge", "second look", "")
    p = R.review_progress(out).first()
    assert (p.no_merge, p.undecided, p.resume_index) == (1, 1, 1)


def test_required_coco_sections(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad.json")
    with open(path, "w") as f:
        json.dump({"images": [], "categories": []}, f)
    assert check_required_sections(read_coco_document(spark, path)).count() == 1


def test_package_zip_for_py_files(spark, tmp_dir):
    import zipfile

    import vantage

    path = vantage.package_zip(os.path.join(tmp_dir, "vantage.zip"))
    names = zipfile.ZipFile(path).namelist()
    assert "vantage/__init__.py" in names and "vantage/operators/metrics.py" in names
    spark.sparkContext.addPyFile(path)  # what a cluster without the package installed would do
