"""Decisions where the application's behaviour was ambiguous."""

import json

from vantage.operators import metrics as M
from vantage.operators.normalize import (
    distinct_categories,
    normalize_annotations,
    normalize_categories,
    normalize_images,
)

IMG = "split string, pos long, id long, file_name string, width double, height double"
ANN = "split string, pos long, id long, image_id long, category_id long, area double, bbox array<double>"
CAT = "split string, pos long, id long, name string"


def test_train_name_wins_then_document_order(spark):
    cats = spark.createDataFrame(
        [("val", 0, 1, "from-val"), ("train", 1, 1, "train-second"), ("train", 0, 1, "train-first"),
         ("val", 0, 2, "only-val")], CAT)
    got = {r.category_id: r.category_name for r in distinct_categories(normalize_categories(cats)).collect()}
    assert got == {1: "train-first", 2: "only-val"}


def test_duplicate_stem_takes_max_area_and_null_category_is_named(spark):
    images = spark.createDataFrame(
        [("train", 0, 10, "a/x.png", 10.0, 10.0), ("val", 0, 10, "b/x.png", 20.0, 10.0)], IMG)
    anns = spark.createDataFrame(
        [("train", 0, 1, 10, 1, 50.0, None), ("val", 0, 2, 10, None, 50.0, None)], ANN)
    cats = spark.createDataFrame([("train", 0, 1, "Car")], CAT)
    mapping = spark.createDataFrame([("x", 5, 0)], "image_id string, viewpoint_id long, seq long")
    inputs = M.TrafficInputs(normalize_images(images), normalize_annotations(anns),
                             normalize_categories(cats), mapping)
    per_image = M.image_metrics(inputs).first()
    # same coco id in both splits joins only within its split (D3); one stem, max area
    assert (per_image.vehicle_count, per_image.image_area) == (2, 200.0)
    row = M.viewpoint_metrics(inputs).first()
    assert json.loads(row.class_distribution_vector) == {"Car": 0.5, "category_unknown": 0.5}
