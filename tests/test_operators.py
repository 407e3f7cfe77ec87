"""Operators against brute force and hand-computed edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vantage.functions import file_stem, l2_normalize, mask_rect
from vantage.operators import checks as C
from vantage.operators import insight as I
from vantage.operators import similarity as S
from vantage.operators.dataset_index import check_bboxes, image_bboxes, image_box_rows, ordered_index

VEC = T.StructType([T.StructField("viewpoint_id", T.LongType()),
                    T.StructField("centroid", T.ArrayType(T.FloatType()))])


def vectors(spark, x, ids=None):
    ids = list(range(len(x))) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in row]) for i, row in zip(ids, x)], VEC)


def unit(x):
    x = np.asarray(x, dtype=np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_similar_pairs_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 6)).astype(np.float32)
    ids = rng.permutation(1000)[:60]
    got = {(r.id_a, r.id_b): r.similarity for r in
           S.similar_pairs(vectors(spark, x, ids), 0.5, block_rows=block_rows).collect()}
    u = unit(x)
    s = u @ u.T
    want = {}
    for i in range(60):
        for j in range(60):
            a, b = int(ids[i]), int(ids[j])
            if a < b and s[i, j] >= 0.5:
                want[(a, b)] = s[i, j]
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


@pytest.mark.parametrize("block_rows", [5, 1000])
def test_nearest_neighbours_ties_and_blocks(spark, block_rows):
    rng = np.random.default_rng(2)
    right = rng.normal(size=(23, 4)).astype(np.float32)
    right[7] = right[3]  # exact duplicate: the lower id must win
    left = np.vstack([right[3] + 0, rng.normal(size=(30, 4)).astype(np.float32)])
    lv = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(left)],
                               "seq long, embedding array<float>")
    out = S.nearest_neighbours(lv, vectors(spark, right), k=3, block_rows=block_rows).collect()
    got = {}
    for r in out:
        got.setdefault(r.left_id, {})[r["rank"]] = r.right_id
    s = unit(left) @ unit(right).T
    for i in range(len(left)):
        order = sorted(range(len(right)), key=lambda j: (-round(s[i, j], 12), j))[:3]
        assert [got[i][k] for k in (1, 2, 3)] == order
    assert got[0][1] == 3 and got[0][2] == 7


def test_nearest_centroid_threshold(spark):
    left = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "seq long, embedding array<float>")
    right = vectors(spark, np.array([[1.0, 0.1], [-1.0, 0.0]], dtype=np.float32))
    rows = {r.seq: r for r in S.nearest_centroid(left, right, threshold=0.9).collect()}
    assert rows[0].viewpoint_id == 0 and rows[1].viewpoint_id is None


def test_l2_normalize_zero_norm_raises(spark):
    good = spark.createDataFrame([([3.0, 4.0],)], "v array<double>")
    assert good.select(l2_normalize("v").alias("u")).first().u == pytest.approx([0.6, 0.8])
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    with pytest.raises(Exception):
        df.select(l2_normalize("v")).collect()
    assert df.select(l2_normalize("v", strict=False).alias("u")).collect()[1].u is None


def test_l2_normalize_is_linear_in_the_dimension(spark):
    """The norm is computed once per vector, not once per element."""
    import time

    took = {}
    for d in (64, 2048):
        df = spark.range(200).select(F.transform(F.sequence(F.lit(1), F.lit(d)), lambda x: x.cast("double")).alias("v"))
        run = lambda: df.select(F.sum(F.get(l2_normalize("v"), 0))).collect()  # noqa: B023, E731
        run()
        t0 = time.perf_counter()
        run()
        took[d] = time.perf_counter() - t0
    assert took[2048] < 5


def test_integer_text(spark):
    from vantage.functions import to_integer

    texts = ["7", "7.0", " 8 ", "7.9", "-3", "x", "7x", "", None, "1e3"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.n for r in df.select(to_integer("t").alias("n")).collect()] == [7, 7, 8, 7, -3, None, None, None, None, None]


def test_metrics_written_with_fractions(spark):
    df = spark.createDataFrame([('{"viewpoint_id": 1.0, "total_images": "3.0", "total_vehicles": "n/a", "entropy": "0.5"}',)], "value string")
    r = I.metrics_from_json_text(df).first()
    assert (r.viewpoint_id, r.total_images, r.total_vehicles, r.entropy) == (1, 3, None, 0.5)


@pytest.mark.parametrize("block_rows", [3, 100])
@pytest.mark.parametrize("k", [1, 2])
def test_nearest_neighbours_in_one_or_many_blocks(spark, block_rows, k):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(40, 8)), rng.normal(size=(11, 8))
    y[7] = y[2]  # a tie: the lower id wins
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "seq long, embedding array<double>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "viewpoint_id long, centroid array<double>")
    got = {}
    for r in S.nearest_neighbours(left, right, k, block_rows=block_rows).collect():
        got.setdefault(r.left_id, {})[r.rank] = r.right_id
    s = unit(x) @ unit(y).T
    want = {i: dict(enumerate(np.argsort(-np.round(s[i], 12), kind="stable")[:k].tolist(), 1)) for i in range(40)}
    assert got == want


def test_nearest_centroid_leaves_the_embeddings_in_place(spark):
    left = spark.createDataFrame([(0, [1.0, 0.0])], "seq long, embedding array<double>")
    right = spark.createDataFrame([(5, [0.0, 1.0])], "viewpoint_id long, centroid array<double>")
    plan = S.nearest_centroid(left, right)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_file_stem_cases(spark):
    names = ["train/000/101.png", "train\\000\\102.png", "103.v2.png", "noext", ".hidden", "a/b.c/d", None]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = [r.s for r in df.select(file_stem("f").alias("s")).collect()]
    assert got == ["101", "102", "103.v2", "noext", "", "d", None]


def test_mask_rect_rounding_and_clamping(spark):
    rows = [([50.5, 60.0, 100.0, 100.0], 500.0, 500.0),   # x1 = round(90.5) = 90 (half to even)
            ([0.0, 0.0, 70.0, 70.0], 500.0, 500.0),       # x1 = 40, x2 = 30 -> empty
            ([10.0, 10.0, 0.0, 5.0], 500.0, 500.0),       # w <= 0
            ([400.0, 400.0, 300.0, 300.0], 500.0, 480.0)]  # clamped to the image
    df = spark.createDataFrame(rows, "bbox array<double>, w double, h double")
    got = [r.r for r in df.select(mask_rect("bbox", "w", "h").alias("r")).collect()]
    assert tuple(got[0]) == (90, 100, 110, 120)
    assert got[1] is None and got[2] is None
    assert tuple(got[3]) == (440, 440, 500, 480)
    # padding 0 keeps the box
    assert tuple(df.limit(1).select(mask_rect("bbox", "w", "h", 0).alias("r")).first().r) == (50, 60, 150, 160)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [0.0, 1.0, 2.0, 3.0, 4.0]], "congestion_index double")
    h = {r.bin: r["count"] for r in I.congestion_histogram(df, 4).collect()}
    assert h == {1: 1, 2: 1, 3: 1, 4: 2}
    same = spark.createDataFrame([(2.0,), (2.0,)], "congestion_index double")
    h = {r.bin: r["count"] for r in I.congestion_histogram(same, 3).collect()}
    assert h == {1: 2, 2: 0, 3: 0}
    empty = df.limit(0)
    assert [r["count"] for r in I.congestion_histogram(empty, 3).collect()] == [0, 0, 0]


def test_insight_filters_and_vectors(spark):
    df = spark.createDataFrame(
        [(1, 5, 10, 0.5, 1.0, '{"a":0.5,"b":0.5}'), (2, 1, 3, 0.1, 0.0, "not json"), (3, 9, 2, None, 2.0, "{}")],
        "viewpoint_id long, total_images long, total_vehicles long, congestion_index double, entropy double, "
        "class_distribution_vector string").withColumn("avg_bbox_density", F.lit(0.1))
    f = I.filter_metrics(df, min_images=2, max_entropy=1.5)
    assert [r.viewpoint_id for r in f.collect()] == [1]
    k = I.kpi_summary(df).first()
    assert (k.viewpoints, k.total_vehicles) == (3, 15) and k.mean_congestion == pytest.approx(0.3)
    assert [r.viewpoint_id for r in I.top_congestion(df, 2).collect()] == [1, 2]
    rows = I.class_vector_explode(df).collect()
    assert [(r.viewpoint_id, r.class_name, r.share) for r in rows] == [(1, "a", 0.5), (1, "b", 0.5)]
    assert I.viewpoint_detail(df).first().viewpoint_id == 1


def test_checks(spark):
    reg = spark.createDataFrame([(0, [1.0, 0.0], 2), (1, [1.0], 1), (2, [0.0, 1.0], 0), (None, [1.0, 0.0], 1)],
                                "viewpoint_id long, centroid array<double>, count long")
    probs = sorted((r.viewpoint_id or -1, r.problem) for r in C.check_registry(reg, 2, last_index=-1).collect())
    assert probs == [(-1, "negative last index"), (-1, "no id"), (1, "centroid of another length"),
                     (2, "count below one")]
    vec = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [1.0])], "seq long, v array<double>")
    assert [r.seq for r in C.check_vectors(vec, "v", 2).orderBy("seq").collect()] == [1, 2]
    ann = spark.createDataFrame([(1, 10, [0.0, 0.0, 1.0, 1.0]), (2, 10, [0.0, 1.0]), (3, 10, None)],
                                "annotation_id long, coco_image_id long, bbox array<double>")
    assert [r.annotation_id for r in check_bboxes(ann).orderBy("annotation_id").collect()] == [2, 3]
    with pytest.raises(C.CheckFailed):
        C.enforce(check_bboxes(ann), "bad bbox")
    with pytest.raises(C.CheckFailed):
        C.require_columns(vec, ["seq", "missing"])


def test_ordered_index_and_boxes(spark):
    images = spark.createDataFrame(
        [("val", 0, 5, "v0.png", "v0"), ("train", 1, 6, "t1.png", "t1"), ("train", 0, 7, "t0.png", "t0")],
        "split string, pos long, coco_image_id long, file_name string, image_id string")
    idx = [(r.seq, r.image_id) for r in ordered_index(images).orderBy("seq").collect()]
    assert idx == [(0, "t0"), (1, "t1"), (2, "v0")]
    # positions run over the whole document: far apart, and beyond any block size
    anns = spark.createDataFrame([("train", 310_000, 7, 2, [1.0, 1.0, 1.0, 1.0]), ("train", 9_999, 7, 1, [0.0, 0.0, 1.0, 1.0])],
                                 "split string, pos long, coco_image_id long, annotation_id long, bbox array<double>")
    listed = image_bboxes(images, anns).collect()
    assert len(listed) == 3
    boxes = {r.image_id: r.bboxes for r in listed}
    rows = sorted((r.image_id, r.position, r.bbox[0]) for r in image_box_rows(images, anns).collect())
    assert rows == [("t0", 0, 0.0), ("t0", 1, 1.0)]
    assert boxes["t0"] == [[0.0, 0.0, 1.0, 1.0], [1.0, 1.0, 1.0, 1.0]] and boxes["v0"] == []


@pytest.mark.parametrize("threshold,pivots,block_rows", [(0.97, 3, 10), (0.9, 2, 1000), (0.5, 4, 7)])
def test_pivot_pruned_pairs_equal_brute_force(spark, threshold, pivots, block_rows):
    rng = np.random.default_rng(11)
    centers = rng.normal(size=(12, 16))
    x = (centers[rng.integers(0, 12, size=240)] + 0.08 * rng.normal(size=(240, 16))).astype(np.float32)
    df = vectors(spark, x)
    got = {(r.id_a, r.id_b) for r in S.similar_pairs(df, threshold, block_rows=block_rows, pivots=pivots).collect()}
    u = unit(x)
    s = u @ u.T
    want = {(i, j) for i in range(240) for j in range(i + 1, 240) if s[i, j] >= threshold}
    assert got == want


def test_pivot_grid_prunes_clustered_data(spark):
    rng = np.random.default_rng(12)
    centers = rng.normal(size=(20, 32))
    x = (centers[rng.integers(0, 20, size=400)] + 0.05 * rng.normal(size=(400, 32))).astype(np.float32)
    found = S.search_pairs(vectors(spark, x), 0.97, block_rows=30, pivots=8)
    assert found.compared(400) < 400 * 399 // 2 / 2  # well under all pairs


def test_grid_with_empty_hash_blocks(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5, 4)).astype(np.float32)
    got = S.similar_pairs(vectors(spark, x), -1.0, block_rows=1).count()  # 5 blocks, some empty
    assert got == 10
