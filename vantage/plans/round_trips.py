"""Registered queries over sources and sinks: each writes tables derived from
the driver's in an application format, reads them back through the library, and
returns what came back."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.functions import json_list_text
from vantage.operators import mapping_index as MI
from vantage.operators import metrics as M
from vantage.operators.checks import RuleCounters
from vantage.operators.normalize import normalize_annotations, normalize_categories, normalize_images
from vantage.operators.util import round_doubles
from vantage.session import free_scratch, scratch_path, shuffles_freed
from vantage.sources import driver_tables as D
from vantage.sources import sinks

NUM_BUCKETS = 8
DOCUMENTS = 4  # COCO documents a split is written as
HOT_SHARE = 0.05  # of all rows, of a key with files of its own
PIECE = 7  # values of a list piece, so that lists of the driver tables have several


def q_registry_round_trip(spark, d):
    """Saved, loaded, and saved again over itself."""
    from vantage.sources.registry import load_registry, save_registry

    path = scratch_path(spark, "registry")
    first = D.centroids_by_label(spark, d)
    save_registry(first, path, 0)
    loaded, last = load_registry(spark, path, D.VECTOR_DIMS)
    total = loaded.agg(F.sum("count")).first()[0]
    save_registry(loaded.withColumn("count", F.col("count") + 1), path, last + total)
    again, last = load_registry(spark, path, D.VECTOR_DIMS)
    norm = F.sqrt(F.aggregate("centroid", F.lit(0.0), lambda a, x: a + x * x))
    return round_doubles(again.select("viewpoint_id", "count", F.size("centroid").alias("dims"), norm.alias("norm"),
                                      F.lit(int(last)).cast("long").alias("last_index")))


def q_decision_log(spark, d):
    """Decisions appended in two batches around a compaction, the
    second taking back those of pairs with an even first id."""
    from vantage.operators import review as R
    from vantage.plans.catalog import candidate_pairs
    from vantage.sources import decision_log as L

    path = scratch_path(spark, "decisions")
    pairs = candidate_pairs(spark, d).select(
        F.col("id_a").alias("viewpoint_id_a"), F.col("id_b").alias("viewpoint_id_b"), F.col("similarity").alias("centroid_similarity"))
    pairs = pairs.withColumns({"merge_decision": F.lit(""), "notes": F.lit("")})
    choice = F.when((F.col("viewpoint_id_a") + F.col("viewpoint_id_b")) % 2 == 0, "merge").otherwise("no_merge")
    events = pairs.select("viewpoint_id_a", "viewpoint_id_b", choice.alias("merge_decision"), "notes", F.lit(0).alias("seq"))
    L.record_all(events, path)
    L.compact(spark, path)
    L.record_all(events.where("viewpoint_id_a % 2 = 0").withColumn("merge_decision", F.lit("")), path)
    return R.review_progress(R.with_candidate_order(L.decided(pairs, path)))


def coco_documents(spark, d) -> Iterator[tuple[str, str]]:
    """The driver's images and annotations as COCO documents: each split's name
    and folder. The folder is emptied when the next split is asked for."""
    images, categories = D.raw_images(spark, d), D.raw_categories(spark, d)
    split = images.select(F.col("id").alias("image_id"), "split")
    annotations = D.raw_annotations(spark, d).join(split, "image_id")
    joined = scratch_path(spark, "coco-annotations")  # smaller than the join's shuffle, which would stand beside the documents
    with shuffles_freed(spark):
        annotations.write.option("compression", "zstd").partitionBy("split").parquet(joined)
    annotations = spark.read.schema(annotations.schema).parquet(joined)
    for name in ("train", "val"):
        mine = images.where(F.col("split") == name).drop("split"), annotations.where(F.col("split") == name).drop("split")
        path = scratch_path(spark, f"coco-{name}")
        sinks.write_coco(*mine, categories, path, DOCUMENTS)
        yield name, path
        free_scratch(spark, [path])
    free_scratch(spark, [joined])


def q_coco_images(spark, d):
    """S4, S5, E1, E2 through COCO documents."""
    from vantage.sources.coco import read_coco_splits

    images, _, _ = read_coco_splits(spark, coco_documents(spark, d))
    return round_doubles(normalize_images(images).select("split", "coco_image_id", "file_name", "image_id", "image_area"))


def q_coco_metrics(spark, d):
    """A1 over tables staged from COCO documents."""
    from vantage.plans.catalog import DRIVER_RULES
    from vantage.sources.coco import read_staged, stage_coco

    folder = scratch_path(spark, "staged")
    stage_coco(spark, coco_documents(spark, d), folder, strict=True)
    images, annotations, categories = read_staged(spark, folder)
    inputs = M.TrafficInputs(normalize_images(images), normalize_annotations(annotations), normalize_categories(categories),
                             D.mapping(spark, d), DRIVER_RULES)
    return round_doubles(M.image_metrics(inputs))


def q_mapping_csv(spark, d):
    """The mapping written in order and read strictly, in file order."""
    from vantage.sources.mapping import read_mapping_strict

    path = scratch_path(spark, "mapping")
    sinks.write_mapping_csv(D.mapping(spark, d), path)
    return read_mapping_strict(spark, path)


def q_metrics_parquet(spark, d):
    """The metrics written in order; place of each row over all files."""
    from vantage.operators.ranking import rank_within_groups
    from vantage.plans.catalog import traffic_inputs

    path = scratch_path(spark, "metrics")
    sinks.write_metrics_parquet(M.viewpoint_metrics(traffic_inputs(spark, d)), path)
    back = spark.read.parquet(path).select("viewpoint_id", "total_vehicles", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rank_within_groups(back, [], ["file", "row"], out="place").select("place", "viewpoint_id", "total_vehicles")


def q_grouped_files(spark, d):
    """The JSON-lines form, lists written in pieces."""
    mapping, path = D.mapping(spark, d), scratch_path(spark, "grouped")
    sinks.write_grouped(MI.mapping_ranks(mapping), MI.viewpoint_sizes(mapping), path, PIECE)
    back = spark.read.schema("viewpoint_id long, image_count long, image_ids array<string>").json(f"{path}/viewpoint_to_images_jsonl")
    return back.where("viewpoint_id is not null").select("viewpoint_id", "image_count", json_list_text("image_ids").alias("image_ids_json"))


def q_bucket_files(spark, d):
    """The CSV form, lists written in pieces."""
    path = scratch_path(spark, "buckets")
    assignment = MI.bucket_assignment(D.mapping(spark, d), NUM_BUCKETS)
    sinks.write_bucket_files(assignment, MI.bucket_totals(assignment, NUM_BUCKETS), MI.bucket_members(assignment), path, PIECE)
    back = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true").csv(f"{path}/bucket_summary")
    ids = F.from_json("viewpoint_ids_json", "array<long>")
    return back.select(
        F.col("bucket_id").cast("int").alias("bucket_id"), F.col("viewpoint_count").cast("long").alias("viewpoint_count"),
        F.col("image_count").cast("long").alias("image_count"), json_list_text(ids).alias("viewpoint_ids_json"))


def q_pair_files(spark, d):
    """The review file written and read, rows in file order."""
    from vantage.operators import review as R
    from vantage.plans.catalog import decided_candidates

    path = scratch_path(spark, "pairs")
    R.write_pair_csv(decided_candidates(spark, d), path)
    return R.read_pair_csv(spark, path)


def q_image_listing(spark, d):
    """Files found by a listing; one folder a nation, one file each."""
    from vantage.sources.files import list_images

    path = scratch_path(spark, "listing")
    nations = D.table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("nation"), F.lit("x").alias("value"))
    nations.repartition("nation").write.partitionBy("nation").text(path)
    found = list_images(spark, path, "*.txt")
    nation = F.regexp_extract("path", "nation=([0-9]+)", 1).cast("long")
    return found.groupBy(nation.alias("nation")).agg(F.count(F.lit(1)).alias("files"))


def q_write_pass_checks(spark, d):
    """C2 to C7 as counters on the pass that writes: rows and broken rules of
    annotations with planted faults (see driver_tables)."""
    raw = D.raw_annotations(spark, d)
    rows = normalize_annotations(raw).withColumn("bbox", F.when(F.col("annotation_id") % 8 == 7, F.slice("bbox", 1, 3)).otherwise(F.col("bbox")))
    rules = RuleCounters("annotations", {
        "box is not four numbers": F.col("bbox").isNull() | (F.size("bbox") != 4),
        "box without area": F.col("bbox_area") <= 0,
        "no image": F.col("coco_image_id").isNull(),
        "odd category": F.col("category_id") % 2 == 1,
    })
    rules.watch(rows).write.parquet(scratch_path(spark, "checked"))
    found = {p: rules.broken().get(p, 0) for p in rules.rules}
    return spark.createDataFrame([("rows", rules.rows), *found.items()], "rule string, rows long")


def q_job_steps(spark, d):
    """The step evidence of a mapping-index run."""
    from vantage.plans import job

    root = scratch_path(spark, "job")
    sinks.write_mapping_csv(D.mapping(spark, d), f"{root}/mapping")
    args = job.build_parser().parse_args(
        ["mapping-index", "--input-csv", f"{root}/mapping", "--output-dir", f"{root}/out", "--num-node-buckets", str(NUM_BUCKETS)])
    job.run_mapping_index(args, spark)
    return spark.read.schema(job.Steps.SCHEMA).json(f"{root}/out/_manifest_steps").select("step", "rows", "problems")


def q_clustered_join(spark, d):
    """Images per viewpoint joined to its bucket, both tables laid out by
    viewpoint: no exchange between them."""
    from vantage.sources.layout import write_clustered

    mapping = D.mapping(spark, d)
    rows = write_clustered(mapping.select("viewpoint_id", "image_id"), scratch_path(spark, "by-viewpoint"), "viewpoint_id", NUM_BUCKETS)
    dealt = write_clustered(MI.bucket_assignment(mapping, NUM_BUCKETS).select("viewpoint_id", "bucket_id"),
                            scratch_path(spark, "by-viewpoint"), "viewpoint_id", NUM_BUCKETS)
    return clustered_counts(rows, dealt)


def clustered_counts(rows: DataFrame, dealt: DataFrame) -> DataFrame:
    return rows.join(dealt.hint("merge"), "viewpoint_id").groupBy("viewpoint_id", "bucket_id").agg(F.count(F.lit(1)).alias("images"))


def hot_mapping(spark, d) -> DataFrame:
    """The mapping with every third image moved to viewpoint 0."""
    moved = F.when(F.col("seq") % 3 == 0, F.lit(0)).otherwise(F.col("viewpoint_id")).cast("long")
    return D.mapping(spark, d).select(moved.alias("viewpoint_id"), "seq")


def q_clustered_hot_join(spark, d):
    """D7 with a viewpoint that holds a third of all images: its rows lie in
    files of their own; each viewpoint's images and their distance to its first."""
    from vantage.sources import layout as L

    mapping = hot_mapping(spark, d)
    firsts = mapping.groupBy("viewpoint_id").agg(F.min("seq").alias("first_seq"))
    hot = L.hot_keys_of([mapping, firsts], "viewpoint_id", HOT_SHARE)
    rows = L.write_parts(mapping, scratch_path(spark, "by-viewpoint"), "viewpoint_id", NUM_BUCKETS, hot)
    first = L.write_parts(firsts, scratch_path(spark, "by-viewpoint"), "viewpoint_id", NUM_BUCKETS, hot)
    per_viewpoint = lambda df: df.groupBy("viewpoint_id").agg(
        F.count(F.lit(1)).alias("images"), F.sum(F.col("seq") - F.col("first_seq")).alias("distance"))
    return L.join_parts(rows, first, "viewpoint_id", then=per_viewpoint)


QUERIES = {
    "registry_round_trip": q_registry_round_trip,
    "decision_log": q_decision_log,
    "coco_images": q_coco_images,
    "coco_metrics": q_coco_metrics,
    "mapping_csv": q_mapping_csv,
    "metrics_parquet": q_metrics_parquet,
    "grouped_files": q_grouped_files,
    "bucket_files": q_bucket_files,
    "pair_files": q_pair_files,
    "image_listing": q_image_listing,
    "write_pass_checks": q_write_pass_checks,
    "job_steps": q_job_steps,
    "clustered_join": q_clustered_join,
    "clustered_hot_join": q_clustered_hot_join,
}
