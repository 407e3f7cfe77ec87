"""The hand-computed mini fixture (FIXTURES.md section 2), read from real
COCO JSON and mapping CSV files."""

import json
import math
import os

import pytest

from vantage.operators import metrics as M
from vantage.operators.normalize import (
    normalize_annotations,
    normalize_categories,
    normalize_images,
)
from vantage.sources.coco import read_coco_splits
from vantage.sources.mapping import read_mapping_csv

COCO = {
    "images": [
        {"id": 10, "file_name": "train/000/101.png", "width": 100, "height": 50},
        {"id": 11, "file_name": "train\\000\\102.png", "width": 100, "height": 50},
        {"id": 12, "file_name": "103.v2.png", "width": 0, "height": 50},
        {"id": 13, "file_name": "104.png", "width": 100, "height": 50},
        {"id": 14, "file_name": "105.png", "width": 100, "height": 50},
    ],
    "annotations": [
        {"id": 1, "image_id": 10, "category_id": 1, "area": 500, "bbox": [0, 0, 9, 9]},
        {"id": 2, "image_id": 10, "category_id": 2, "bbox": [0, 0, 20, 50]},
        {"id": 3, "image_id": 10, "category_id": 3},
        {"id": 4, "image_id": 11, "category_id": 1, "area": -5, "bbox": [0, 0, 1, 1]},
        {"id": 5, "image_id": 11, "category_id": 9, "area": 250},
        {"id": 6, "image_id": 12, "category_id": 4, "area": 0.5},
        {"id": 7, "image_id": 12, "category_id": 3, "bbox": [1, 2, 3]},
        {"id": 8, "image_id": 14, "category_id": 1, "area": 100},
        {"id": 9, "image_id": 99, "category_id": 1, "area": 1},
    ],
    "categories": [
        {"id": 1, "name": "Car"},
        {"id": 2, "name": "Mini-Bus"},
        {"id": 3, "name": "Motorcycle"},
        {"id": 4, "name": "car"},
    ],
}
MAPPING = "image_id,viewpoint_id\n101,7\n102,7\n103.v2,8\n104,8\n105,x\n999,8\n"


@pytest.fixture()
def inputs(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "train.json"), "w") as f:
        json.dump(COCO, f, indent=2)
    with open(os.path.join(tmp_dir, "val.json"), "w") as f:
        json.dump({"images": [], "annotations": [], "categories": []}, f)
    with open(os.path.join(tmp_dir, "mapping.csv"), "w") as f:
        f.write(MAPPING)
    images, anns, cats = read_coco_splits(
        spark, {"train": os.path.join(tmp_dir, "train.json"), "val": os.path.join(tmp_dir, "val.json")}
    )
    return M.TrafficInputs(
        images=normalize_images(images),
        annotations=normalize_annotations(anns),
        categories=normalize_categories(cats),
        mapping=read_mapping_csv(spark, os.path.join(tmp_dir, "mapping.csv")),
    )


def test_image_metrics(inputs):
    rows = {(r.viewpoint_id, r.image_id): r for r in M.image_metrics(inputs).collect()}
    assert set(rows) == {(7, "101"), (7, "102"), (8, "103.v2")}
    r = rows[(7, "101")]
    assert (r.vehicle_count, r.total_bbox_area, r.image_area) == (3, 1500.0, 5000.0)
    assert (r.heavy_vehicle_count, r.two_wheeler_count) == (1, 1)
    assert r.bbox_density == pytest.approx(0.3)
    r = rows[(7, "102")]
    assert (r.vehicle_count, r.total_bbox_area, r.heavy_vehicle_count) == (2, 250.0, 0)
    assert r.bbox_density == pytest.approx(0.05)
    r = rows[(8, "103.v2")]
    assert (r.vehicle_count, r.total_bbox_area, r.image_area, r.two_wheeler_count) == (2, 0.5, 1.0, 1)


def test_viewpoint_metrics(inputs):
    rows = {r.viewpoint_id: r for r in M.viewpoint_metrics(inputs).collect()}
    assert set(rows) == {7, 8}
    a, b = rows[7], rows[8]
    assert (a.total_images, a.total_vehicles, b.total_images, b.total_vehicles) == (2, 5, 1, 2)
    assert a.avg_vehicle_count == a.per_vehicle_count == 2.5
    assert b.avg_vehicle_count == b.per_vehicle_count == 2.0
    assert a.avg_bbox_density == pytest.approx(0.175)
    assert b.avg_bbox_density == pytest.approx(0.5)
    assert (a.heavy_vehicle_ratio, a.two_wheeler_ratio) == pytest.approx((0.2, 0.2))
    assert (b.heavy_vehicle_ratio, b.two_wheeler_ratio) == pytest.approx((0.0, 0.5))
    assert a.entropy == pytest.approx(1.921928094887, abs=1e-9)
    assert b.entropy == pytest.approx(1.0)
    assert a.congestion_index == pytest.approx(0.4375)
    assert b.congestion_index == pytest.approx(1.0)
    assert a.class_distribution_vector == '{"Car":0.4,"Mini-Bus":0.2,"Motorcycle":0.2,"category_9":0.2}'
    assert b.class_distribution_vector == '{"Motorcycle":0.5,"car":0.5}'


def test_separate_operators_agree_with_flagship(inputs):
    flag = {r.viewpoint_id: r for r in M.viewpoint_metrics(inputs).collect()}
    core = {r.viewpoint_id: r for r in M.viewpoint_core(inputs).collect()}
    ent = {r.viewpoint_id: r.entropy for r in M.entropy(inputs).collect()}
    for vp, r in flag.items():
        assert core[vp].total_vehicles == r.total_vehicles
        assert core[vp].avg_bbox_density == pytest.approx(r.avg_bbox_density)
        assert ent[vp] == pytest.approx(r.entropy)
    probs = M.class_probs(inputs).collect()
    for vp in flag:
        assert math.isclose(sum(p.class_prob for p in probs if p.viewpoint_id == vp), 1.0)


def test_metamorphic_input_order(spark, inputs):
    """Shuffling the input rows does not change the result."""
    base = sorted(M.viewpoint_metrics(inputs).collect())
    shuffled = M.TrafficInputs(
        images=inputs.images.repartition(3),
        annotations=inputs.annotations.orderBy("annotation_id", ascending=False).repartition(5),
        categories=inputs.categories,
        mapping=inputs.mapping.repartition(2),
    )
    assert sorted(M.viewpoint_metrics(shuffled).collect()) == base


def test_metamorphic_bounds_on_driver_tables(spark):
    """0 <= entropy <= log2(#classes); class shares sum to 1; ratios in [0, 1]."""
    from tests.conftest import SF_SMALL
    from vantage.plans.catalog import viewpoint_metrics

    for r in viewpoint_metrics(spark, SF_SMALL).collect():
        shares = json.loads(r.class_distribution_vector)
        assert 0.0 <= r.entropy <= math.log2(len(shares)) + 1e-9
        assert math.isclose(sum(shares.values()), 1.0, abs_tol=1e-5 * len(shares))
        assert 0.0 <= r.heavy_vehicle_ratio <= 1.0 and 0.0 <= r.two_wheeler_ratio <= 1.0
        assert r.per_vehicle_count == pytest.approx(r.avg_vehicle_count)
