"""Versioned tables, the registry and the decision log: saves over a loaded
version, crashes at every write, readers meanwhile, expiry."""

import pytest

from vantage.operators import review as R
from vantage.sources import decision_log as L
from vantage.sources import registry as G
from vantage.sources import versions as V

REG = "viewpoint_id long, centroid array<double>, count long"


def reg(spark, *rows):
    return spark.createDataFrame([(i, [3.0, 4.0], n) for i, n in rows], REG)


def counts(df):
    return {r.viewpoint_id: r["count"] for r in df.collect()}


def test_save_over_the_loaded_registry(spark, tmp_dir):
    path = f"{tmp_dir}/r"
    G.save_registry(reg(spark, (0, 2), (1, 1)), path, 3)
    loaded, _ = G.load_registry(spark, path, 2)
    grown = loaded.withColumn("count", loaded["count"] + 1)
    G.save_registry(grown, path, 5)
    again, last = G.load_registry(spark, path, 2)
    assert last == 5 and counts(again) == {0: 3, 1: 2}
    assert counts(loaded) == {0: 2, 1: 1}  # a reader keeps the version it opened
    assert G.registry_version(spark, path) == 2
    old, last = G.load_registry(spark, path, 2, version=1)
    assert last == 3 and counts(old) == {0: 2, 1: 1}
    with pytest.raises(FileNotFoundError):
        G.load_registry(spark, path, 2, version=9)
    with pytest.raises(FileNotFoundError):
        G.load_registry(spark, f"{tmp_dir}/none", 2, missing_ok=False)


@pytest.mark.parametrize("moment", ["begin", "rows", "commit"])
def test_a_crash_leaves_the_old_version(spark, tmp_dir, monkeypatch, moment):
    path = f"{tmp_dir}/r"
    G.save_registry(reg(spark, (0, 2)), path, 2)
    plain = V._append

    def failing(spark, path, event, *more, **kw):
        if event == moment:
            raise OSError("lost")
        plain(spark, path, event, *more, **kw)

    monkeypatch.setattr(V, "_append", failing)
    broken = reg(spark, (0, 9)).selectExpr("viewpoint_id", "centroid", "cast(raise_error('lost') as long) count") if moment == "rows" else reg(spark, (0, 9))
    with pytest.raises(Exception, match="lost"):
        G.save_registry(broken, path, 9)
    monkeypatch.undo()
    loaded, last = G.load_registry(spark, path, 2)
    assert last == 2 and counts(loaded) == {0: 2}
    G.save_registry(reg(spark, (0, 4)), path, 4)
    loaded, last = G.load_registry(spark, path, 2)
    assert last == 4 and counts(loaded) == {0: 4}


def test_old_versions_and_dead_saves_expire(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    plain = V._append
    monkeypatch.setattr(V, "_append", lambda s, p, event, *a, **k: plain(s, p, event, *a, **k) if event != "commit" else (_ for _ in ()).throw(OSError()))
    with pytest.raises(OSError):
        V.save_version(reg(spark, (7, 7)), path)
    monkeypatch.undo()
    for n in range(1, 5):
        V.save_version(reg(spark, (0, n)), path, {"n": n})
    assert [v.facts["n"] for v in V.versions(spark, path)] == [1, 2, 3, 4]
    assert V.expire_versions(spark, path, keep=2) == 3  # two versions and the dead save
    assert [v.facts["n"] for v in V.versions(spark, path)] == [3, 4]
    assert V.expire_versions(spark, path, keep=2) == 0
    assert counts(V.read_version(spark, path, V.latest_version(spark, path))) == {0: 4}


def test_two_writers_do_not_lose_a_save_silently(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    V.save_version(reg(spark, (0, 1)), path)
    plain = V._append

    def slow(s, p, event, *a, **k):
        plain(s, p, event, *a, **k)
        if event == "begin":
            monkeypatch.setattr(V, "_append", plain)
            V.save_version(reg(spark, (0, 2)), path)  # another writer, meanwhile

    monkeypatch.setattr(V, "_append", slow)
    with pytest.raises(V.SaveConflict):
        V.save_version(reg(spark, (0, 3)), path)
    assert counts(V.read_version(spark, path, V.latest_version(spark, path))) == {0: 2}


CANDIDATE = "viewpoint_id_a long, viewpoint_id_b long, centroid_similarity double, merge_decision string, notes string, seq long"


def candidates(spark, n=5):
    return spark.createDataFrame([(i, i + 1, 0.99, "", "", i) for i in range(n)], CANDIDATE)


def decisions(spark, path):
    return {(r.viewpoint_id_a, r.viewpoint_id_b): (r.merge_decision, r.notes) for r in L.latest_decisions(spark, path).collect()}


def test_decision_log(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    assert decisions(spark, path) == {}
    L.record(spark, path, [(0, 1, "merge", ""), (1, 2, "merge", "first"), (1, 2, "no_merge", "second")])
    assert decisions(spark, path) == {(0, 1): ("merge", ""), (1, 2): ("no_merge", "second")}
    assert L.compact(spark, path) == 1
    L.record(spark, path, [(0, 1, "", "taken back")])
    L.record(spark, path, [(2, 3, "merge", None)])
    want = {(0, 1): ("", "taken back"), (1, 2): ("no_merge", "second"), (2, 3): ("merge", "")}
    assert decisions(spark, path) == want
    for k in range(2, 6):  # compaction changes nothing, whatever generations are emptied
        assert L.compact(spark, path) == k
        assert decisions(spark, path) == want
    progress = R.review_progress(L.decided(candidates(spark), path)).first()
    assert (progress.total, progress.merge, progress.no_merge, progress.undecided, progress.resume_index) == (5, 1, 1, 3, 0)
    assert L.unknown_pairs(candidates(spark, 2), path).count() == 1
    for bad in ([(1, 0, "merge", "")], [(0, 1, "perhaps", "")]):
        with pytest.raises(ValueError):
            L.record(spark, path, bad)


def test_a_crash_between_append_and_compaction_loses_nothing(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/log"
    L.record(spark, path, [(0, 1, "merge", "")])
    L.compact(spark, path)
    L.record(spark, path, [(1, 2, "merge", "")])
    plain = V._append
    for moment in ("begin", "commit"):
        monkeypatch.setattr(V, "_append", lambda s, p, e, *a, **k: plain(s, p, e, *a, **k) if e != moment else (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            L.compact(spark, path)
        monkeypatch.undo()
        assert decisions(spark, path) == {(0, 1): ("merge", ""), (1, 2): ("merge", "")}
    L.compact(spark, path)
    # a late row of the generation before is still taken
    spark.createDataFrame([(2, 3, "merge", "", (1, 0))], L.EVENTS).write.mode("append").parquet(f"{path}/events/g=1")
    assert decisions(spark, path) == {(0, 1): ("merge", ""), (1, 2): ("merge", ""), (2, 3): ("merge", "")}


def test_events_file_and_jobs(spark, tmp_dir):
    from vantage.plans import job

    path = f"{tmp_dir}/log"
    rows = spark.createDataFrame([(0, 1, "merge", None, 0), (0, 1, None, "undone", 1), (3, 4, "no_merge", "x", 2)],
                                 "viewpoint_id_a long, viewpoint_id_b long, merge_decision string, notes string, seq long")
    L.record_all(rows, path)
    assert decisions(spark, path) == {(0, 1): ("", "undone"), (3, 4): ("no_merge", "x")}
    with pytest.raises(Exception, match="unknown decision"):
        L.record_all(rows.selectExpr("viewpoint_id_a", "viewpoint_id_b", "'maybe' merge_decision", "notes", "seq"), path)
    assert job.main(["record", "--log", path, "--pair", "0", "1", "--decision", "merge", "--shuffle-partitions", "8"]) == {"recorded": 1}
    assert job.main(["compact", "--log", path, "--shuffle-partitions", "8"]) == {"snapshot": 1}
    R.write_pair_csv(candidates(spark).selectExpr(
        "viewpoint_id_a", "'a' image_id_a", "'p' image_path_a", "viewpoint_id_b", "'b' image_id_b", "'q' image_path_b",
        "centroid_similarity", "merge_decision", "notes", "seq"), f"{tmp_dir}/c")
    facts = job.main(["review", "--candidates-csv", f"{tmp_dir}/c", "--log", path, "--shuffle-partitions", "8"])
    assert facts == {"total": 5, "merge": 1, "no_merge": 1, "undecided": 3, "resume_index": 1}
