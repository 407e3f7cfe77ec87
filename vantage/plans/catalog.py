"""Registered queries over the driver tables.

Each entry takes (spark, sf_dir) and returns a DataFrame built from the
tables in ``sf_dir`` (see ``vantage.sources.driver_tables`` for how the
domain tables are derived). Doubles are rounded to 6 digits at the very end
so the results compare with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions import file_stem, json_list_text, keyword_flag
from vantage.operators import checks as C
from vantage.operators import dataset_index as X
from vantage.operators import insight as I
from vantage.operators import mapping_index as MI
from vantage.operators import metrics as M
from vantage.operators import similarity as S
from vantage.operators.normalize import (
    normalize_annotations,
    normalize_categories,
    normalize_images,
    union_splits,
)
from vantage.operators.util import round_doubles
from vantage.session import scratch_path
from vantage.sources import driver_tables as D

Query = Callable[[SparkSession, str], DataFrame]

DRIVER_RULES = M.KeywordRules(heavy=D.DRIVER_HEAVY_KEYWORDS, two_wheeler=D.DRIVER_TWO_WHEELER_KEYWORDS)


def traffic_inputs(spark: SparkSession, sf_dir: str) -> M.TrafficInputs:
    return M.TrafficInputs(
        images=normalize_images(D.raw_images(spark, sf_dir)),
        annotations=normalize_annotations(D.raw_annotations(spark, sf_dir)),
        categories=normalize_categories(D.raw_categories(spark, sf_dir)),
        mapping=D.mapping(spark, sf_dir),
        rules=DRIVER_RULES,
    )


# --- normalisation ---------------------------------------------------------

def q_images_norm(spark, d):
    return round_doubles(normalize_images(D.raw_images(spark, d)))


def q_file_stem(spark, d):
    pages = D.table(spark, d, "pages")
    return pages.select("page_id", "url", file_stem("url").alias("stem"))


def q_union_splits(spark, d):
    raw = D.raw_images(spark, d)
    train = normalize_images(raw.where(F.col("split") == "train"))
    val = normalize_images(raw.where(F.col("split") == "val"))
    return union_splits(train, val).select("split", "pos", "coco_image_id", "image_id")


def q_bbox_area(spark, d):
    ann = normalize_annotations(D.raw_annotations(spark, d))
    return round_doubles(ann.select("annotation_id", "coco_image_id", "category_id", "bbox_area"))


def q_keyword_flags(spark, d):
    cats = normalize_categories(D.raw_categories(spark, d))
    return cats.select(
        "category_id",
        "category_name",
        keyword_flag("category_name", DRIVER_RULES.heavy).alias("is_heavy"),
        keyword_flag("category_name", DRIVER_RULES.two_wheeler).alias("is_two_wheeler"),
        keyword_flag("category_name", M.KeywordRules().heavy).alias("is_vehicle_heavy"),
    )


# --- metrics ---------------------------------------------------------------

def q_ann_image_join(spark, d):
    j = M.annotation_join(traffic_inputs(spark, d))
    return round_doubles(j.select("annotation_id", "coco_image_id", "viewpoint_id", "image_id",
                                  "category_id", "bbox_area", "image_area"))


def q_image_metrics(spark, d):
    return round_doubles(M.image_metrics(traffic_inputs(spark, d)))


def q_viewpoint_core(spark, d):
    return round_doubles(M.viewpoint_core(traffic_inputs(spark, d)))


def q_class_counts(spark, d):
    return M.class_counts(traffic_inputs(spark, d))


def q_class_probs(spark, d):
    return round_doubles(M.class_probs(traffic_inputs(spark, d)))


def q_entropy(spark, d):
    return round_doubles(M.entropy(traffic_inputs(spark, d)))


def q_class_distribution(spark, d):
    return M.class_distribution_rows(traffic_inputs(spark, d))


def viewpoint_metrics(spark: SparkSession, d: str) -> DataFrame:
    return M.viewpoint_metrics(traffic_inputs(spark, d))


def q_viewpoint_metrics(spark, d):
    return round_doubles(viewpoint_metrics(spark, d))


def q_preview_top(spark, d):
    return round_doubles(M.preview_top(viewpoint_metrics(spark, d), 20))


# --- mapping index -----------------------------------------------------------

NUM_BUCKETS = 8
SMOKE_VIEWPOINTS = 10
SMOKE_IMAGES = 100


def q_grouped_mapping(spark, d):
    g = MI.grouped_mapping(D.mapping(spark, d))
    return g.select("viewpoint_id", "image_count", json_list_text("image_ids").alias("image_ids_json"))


def q_bucket_assignment(spark, d):
    return MI.bucket_assignment(D.mapping(spark, d), NUM_BUCKETS)


def q_bucket_summary(spark, d):
    b = MI.bucket_summary(MI.bucket_assignment(D.mapping(spark, d), NUM_BUCKETS), NUM_BUCKETS)
    return b.select("bucket_id", "viewpoint_count", "image_count",
                    json_list_text("viewpoint_ids").alias("viewpoint_ids_json"))


def q_mapping_ranks(spark, d):
    return MI.mapping_ranks(D.mapping(spark, d))


def q_bucket_members(spark, d):
    return MI.bucket_members(MI.bucket_assignment(D.mapping(spark, d), NUM_BUCKETS))


def q_smoke_subset(spark, d):
    return MI.smoke_subset(D.mapping(spark, d), SMOKE_VIEWPOINTS, SMOKE_IMAGES)


def q_representative_image(spark, d):
    return MI.representative_image(D.mapping(spark, d))


# --- insight -----------------------------------------------------------------

MIN_IMAGES, MAX_ENTROPY, TOP_N, BINS = 5, 5.0, 20, 40


def metrics_table(spark: SparkSession, d: str) -> DataFrame:
    """The viewpoint metrics as the insight queries read them."""
    return viewpoint_metrics(spark, d)


def filtered_metrics(spark, d):
    return I.filter_metrics(metrics_table(spark, d), MIN_IMAGES, MAX_ENTROPY)


def q_coerce_metrics(spark, d):
    # planted: whole numbers written with a fraction, and text that is no number
    m = metrics_table(spark, d).withColumns({
        "total_images": F.concat(F.col("total_images").cast("string"), F.lit(".0")),
        "total_vehicles": F.when(F.col("viewpoint_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("total_vehicles").cast("string")),
    })
    text = m.select(F.to_json(F.struct("*")).alias("value"))
    return round_doubles(I.metrics_from_json_text(text))


def q_filter_metrics(spark, d):
    return round_doubles(filtered_metrics(spark, d))


def q_kpi_summary(spark, d):
    return round_doubles(I.kpi_summary(filtered_metrics(spark, d)))


def q_top_congestion(spark, d):
    return round_doubles(I.top_congestion(filtered_metrics(spark, d), TOP_N))


def q_congestion_histogram(spark, d):
    return round_doubles(I.congestion_histogram(filtered_metrics(spark, d), BINS))


def q_composition_view(spark, d):
    return round_doubles(I.composition_view(filtered_metrics(spark, d)))


def q_viewpoint_detail(spark, d):
    return round_doubles(I.viewpoint_detail(filtered_metrics(spark, d)))


def q_class_vector_explode(spark, d):
    return I.class_vector_explode(metrics_table(spark, d))


# --- vectors -------------------------------------------------------------------

PAIR_THRESHOLD = D.DRIVER_PAIR_THRESHOLD


def q_l2_normalize(spark, d):
    from vantage.functions import l2_normalize

    e = D.embeddings(spark, d)
    return round_doubles(e.select("seq", F.posexplode(l2_normalize("embedding")).alias("d", "x")))


def q_cosine_pairs(spark, d):
    return round_doubles(S.label_cosine(D.embeddings(spark, d), D.centroids_by_label(spark, d)))


def q_nearest_centroid(spark, d):
    return round_doubles(S.nearest_centroid(D.embeddings(spark, d), D.centroids_by_label(spark, d)))


def candidate_pairs(spark, d):
    """All pairs, written once: the queries below read them several times."""
    pairs = S.similar_pairs(D.embedding_registry(spark, d), PAIR_THRESHOLD)
    return stored(pairs, "pairs")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_similar_pairs(spark, d):
    return round_doubles(S.similar_pairs(D.embedding_registry(spark, d), PAIR_THRESHOLD).select(
        F.col("id_a").alias("viewpoint_id_a"), F.col("id_b").alias("viewpoint_id_b"),
        F.col("similarity").alias("centroid_similarity")))


def q_pairs_with_images(spark, d):
    from vantage.operators.review import pairs_with_images

    images = normalize_images(D.raw_images(spark, d)).select("image_id", F.col("file_name").alias("path"))
    out = pairs_with_images(candidate_pairs(spark, d), MI.representative_image(D.mapping(spark, d)), images,
                            strict=False)
    return round_doubles(out)


# --- dataset index -------------------------------------------------------------

MASK_PADDING_DRIVER = 0  # the application's -40 empties every driver box (w <= 50, h <= 7)


def q_ordered_index(spark, d):
    return X.ordered_index(normalize_images(D.raw_images(spark, d)))


def file_wide_annotations(spark, d):
    """Annotations whose positions run over the whole document, as in COCO
    files, instead of from 1 in each image."""
    raw = D.raw_annotations(spark, d).withColumn("pos", F.col("image_id") * 8 + F.col("pos"))
    return normalize_annotations(raw)


def q_image_bboxes(spark, d):
    out = X.image_bboxes(normalize_images(D.raw_images(spark, d)), file_wide_annotations(spark, d))
    return out.select("split", "coco_image_id", "image_id", F.to_json("bboxes").alias("bboxes_json"))


def q_image_box_rows(spark, d):
    out = X.image_box_rows(normalize_images(D.raw_images(spark, d)), file_wide_annotations(spark, d))
    return out.select("split", "coco_image_id", "image_id", "position", F.to_json("bbox").alias("bbox_json"))


def q_mask_rects(spark, d):
    # planted: corners off the origin, some outside the image, with halves
    box = F.col("bbox")
    shift = (F.col("id") % 9).cast("double") * 1.25 - 2.5
    raw = D.raw_annotations(spark, d).withColumn(
        "bbox", F.array(shift, shift - 0.25, F.get(box, 2) + 0.5, F.get(box, 3) + 0.25))
    return X.mask_rects(normalize_images(D.raw_images(spark, d)), normalize_annotations(raw), MASK_PADDING_DRIVER)


# --- registry, review --------------------------------------------------------------

def q_registry_totals(spark, d):
    return D.label_counts(spark, d).agg(F.count(F.lit(1)).alias("viewpoints"), F.sum("count").alias("images"))


def decided_candidates(spark, d):
    """Candidate rows with decisions derived from the pair ids:
    (a + b) % 3 -> 0 merge, 1 no_merge, 2 undecided."""
    from vantage.operators import review as R

    images = normalize_images(D.raw_images(spark, d)).select("image_id", F.col("file_name").alias("path"))
    cands = R.pairs_with_images(candidate_pairs(spark, d), MI.representative_image(D.mapping(spark, d)), images,
                                strict=False)
    r = (F.col("viewpoint_id_a") + F.col("viewpoint_id_b")) % 3
    events = cands.select(
        "viewpoint_id_a", "viewpoint_id_b",
        F.when(r == 0, "merge").when(r == 1, "no_merge").otherwise("").alias("merge_decision"),
        F.lit("").alias("notes"), F.lit(0).cast("long").alias("event_seq"),
    )
    return R.with_candidate_order(R.apply_decisions(cands, events))


def q_review_progress(spark, d):
    from vantage.operators import review as R

    return R.review_progress(decided_candidates(spark, d))


# --- checks (on views with planted faults) ----------------------------------------

def q_check_bbox(spark, d):
    raw = D.raw_annotations(spark, d).withColumn(
        "bbox", F.when(F.col("pos") == 7, F.slice("bbox", 1, 3)).otherwise(F.col("bbox")))
    bad = X.check_bboxes(normalize_annotations(raw))
    return bad.select("annotation_id", "coco_image_id", F.size("bbox").alias("bbox_size"))


def q_check_vectors(spark, d):
    e = D.embeddings(spark, d).withColumn(
        "embedding", F.when(F.col("label") == 3, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")))
    return round_doubles(C.check_vectors(e, "embedding", 64))


def q_check_duplicates(spark, d):
    pages = D.table(spark, d, "pages").select(file_stem("url").alias("stem"))
    return C.check_duplicates(pages, ["stem"])


def q_check_unmatched(spark, d):
    annotated = M.annotation_join(traffic_inputs(spark, d)).select("image_id")
    return C.check_unmatched(D.mapping(spark, d).select("image_id", "viewpoint_id"), annotated, ["image_id"])


def q_check_resume(spark, d):
    """Planted: a dataset that lacks its last images and holds two in each
    other's place, a count too many and a last index too low."""
    index = X.ordered_index(normalize_images(D.raw_images(spark, d))).select("seq", "image_id")
    short = index.where(F.col("seq") % 50 != 49)
    mapping = D.mapping(spark, d)
    registry = MI.viewpoint_sizes(mapping).select("viewpoint_id", (F.col("image_count") + 1).alias("count"))
    return C.check_resume(short, mapping, registry, mapping.count() - 3)


def q_check_conservation(spark, d):
    """Planted: rows without assignment, rows assigned twice, rows that the
    dataset doesn't have."""
    e = D.embeddings(spark, d)
    found = S.nearest_centroid(e, D.centroids_by_label(spark, d)).select("seq", "viewpoint_id")
    lost = found.where(F.col("seq") % 11 != 3)
    twice = found.where(F.col("seq") % 13 == 5)
    foreign = found.where(F.col("seq") % 17 == 1).withColumn("seq", -F.col("seq"))
    mapping = stored(lost.unionByName(twice).unionByName(foreign), "assignments")
    return C.check_conservation(e, mapping, D.label_counts(spark, d))


def q_check_registry(spark, d):
    """Planted: one fault of each kind by label."""
    r = D.centroids_by_label(spark, d)
    v = F.col("viewpoint_id")
    bad = r.select(
        F.when(v == 1, None).otherwise(v).alias("viewpoint_id"),
        F.when(v == 2, None).when(v == 3, F.slice("centroid", 1, 5)).otherwise(F.col("centroid")).alias("centroid"),
        F.when(v == 4, None).when(v == 5, F.lit(0).cast("long")).otherwise(F.col("count")).alias("count"),
    )
    return C.check_registry(bad, D.VECTOR_DIMS, -1)


def q_check_alignment(spark, d):
    """Planted: a decision list that lost its first row and some later ids."""
    from vantage.operators import review as R

    c = stored(decided_candidates(spark, d), "candidates")
    moved = c.withColumn("seq", F.col("seq") - 1).where("seq >= 0")
    same = c.where("seq % 2 = 0").withColumn("viewpoint_id_b", F.col("viewpoint_id_b") + (F.col("seq") % 3))
    return R.check_alignment(c, same.unionByName(moved.where("seq % 2 = 1")))


# --- casts, names, paths (on planted values) ----------------------------------------

def q_mapping_cast(spark, d):
    """Viewpoint ids as the lenient mapping read casts them."""
    from vantage.functions import to_integer

    m = D.mapping(spark, d)
    v = F.col("viewpoint_id").cast("string")
    k = F.col("seq") % 5
    text = F.when(k == 0, F.concat(v, F.lit(".0"))).when(k == 1, F.concat(F.lit(" "), v, F.lit(" "))) \
        .when(k == 2, F.concat(v, F.lit("x"))).when(k == 3, F.concat(v, F.lit(".9"))).otherwise(v)
    return m.select("image_id", "seq", to_integer(text).alias("viewpoint_id")).dropna(subset=["viewpoint_id"])


def q_mapping_trimmed(spark, d):
    m = D.mapping(spark, d)
    padded = F.concat(F.lit("  "), F.col("image_id"), F.lit(" "))
    return m.select(F.trim(padded).alias("image_id"), F.trim(F.concat(F.col("viewpoint_id").cast("string"), F.lit(" "))).cast("long").alias("viewpoint_id"), "seq")


def q_unknown_categories(spark, d):
    """Class counts when every tenth category is missing."""
    t = traffic_inputs(spark, d)
    t.categories = t.categories.where(F.col("category_id") % 10 != 0)
    return M.class_counts(t)


def q_conflicting_categories(spark, d):
    """One name per id when the splits disagree: the train name wins."""
    from vantage.operators.normalize import distinct_categories

    raw = D.raw_categories(spark, d)
    train = raw.where(F.col("id") % 3 != 0).withColumn("split", F.lit("train"))
    val = raw.withColumns({"split": F.lit("val"), "name": F.concat(F.lit("val "), F.col("name"))})
    return distinct_categories(normalize_categories(train.unionByName(val)))


def q_split_image_join(spark, d):
    """The join on (split, image id) when both splits use the same ids."""
    images = D.raw_images(spark, d)
    other = images.withColumns({
        "split": F.when(F.col("split") == "val", "train").otherwise("val"),
        "file_name": F.concat(F.lit("other/"), F.col("id").cast("string"), F.lit("b.png")),
    })
    ann = D.raw_annotations(spark, d).withColumn("split", F.when(F.col("id") % 3 == 0, "val").otherwise("train"))
    m = D.mapping(spark, d)
    both = m.unionByName(m.withColumn("image_id", F.concat("image_id", F.lit("b"))))
    t = M.TrafficInputs(normalize_images(images.unionByName(other)), normalize_annotations(ann),
                        normalize_categories(D.raw_categories(spark, d)), both, rules=DRIVER_RULES)
    return M.annotation_join(t).select("split", "annotation_id", "image_id", "viewpoint_id")


def q_resolve_paths(spark, d):
    """Index rows with their file path; a val image ending in 9 has no file."""
    images = normalize_images(D.raw_images(spark, d))
    name = F.regexp_extract("file_name", r"([^/]*)$", 1)
    files = images.where(~((F.col("split") == "val") & F.col("image_id").endswith("9"))).select(
        F.concat(F.lit("root-"), F.col("split"), F.lit("/data/"), name).alias("path"))
    lookup = X.split_path_lookup(files, {"train": "root-train", "val": "root-val"})
    return X.resolve_paths(images.select("split", name.alias("file_name"), "image_id"), lookup, strict=False)


def q_pair_csv_rows(spark, d):
    """The text columns of the review file."""
    from vantage.operators.review import pair_csv_rows

    return pair_csv_rows(decided_candidates(spark, d))


def q_viewpoint_ids(spark, d):
    return I.viewpoint_ids(filtered_metrics(spark, d))


QUERIES: dict[str, Query] = {
    "images_norm": q_images_norm,
    "file_stem": q_file_stem,
    "union_splits": q_union_splits,
    "bbox_area": q_bbox_area,
    "keyword_flags": q_keyword_flags,
    "ann_image_join": q_ann_image_join,
    "image_metrics": q_image_metrics,
    "viewpoint_core": q_viewpoint_core,
    "class_counts": q_class_counts,
    "class_probs": q_class_probs,
    "entropy": q_entropy,
    "class_distribution": q_class_distribution,
    "viewpoint_metrics": q_viewpoint_metrics,
    "preview_top": q_preview_top,
    "grouped_mapping": q_grouped_mapping,
    "bucket_assignment": q_bucket_assignment,
    "bucket_summary": q_bucket_summary,
    "smoke_subset": q_smoke_subset,
    "representative_image": q_representative_image,
    "coerce_metrics": q_coerce_metrics,
    "filter_metrics": q_filter_metrics,
    "kpi_summary": q_kpi_summary,
    "top_congestion": q_top_congestion,
    "congestion_histogram": q_congestion_histogram,
    "composition_view": q_composition_view,
    "viewpoint_detail": q_viewpoint_detail,
    "class_vector_explode": q_class_vector_explode,
    "l2_normalize": q_l2_normalize,
    "cosine_pairs": q_cosine_pairs,
    "nearest_centroid": q_nearest_centroid,
    "similar_pairs": q_similar_pairs,
    "pairs_with_images": q_pairs_with_images,
    "ordered_index": q_ordered_index,
    "image_bboxes": q_image_bboxes,
    "mask_rects": q_mask_rects,
    "registry_totals": q_registry_totals,
    "review_progress": q_review_progress,
    "check_bbox": q_check_bbox,
    "check_vectors": q_check_vectors,
    "check_duplicates": q_check_duplicates,
    "check_unmatched": q_check_unmatched,
    "check_resume": q_check_resume,
    "check_conservation": q_check_conservation,
    "check_registry": q_check_registry,
    "check_alignment": q_check_alignment,
    "mapping_ranks": q_mapping_ranks,
    "bucket_members": q_bucket_members,
    "image_box_rows": q_image_box_rows,
    "mapping_cast": q_mapping_cast,
    "mapping_trimmed": q_mapping_trimmed,
    "unknown_categories": q_unknown_categories,
    "conflicting_categories": q_conflicting_categories,
    "split_image_join": q_split_image_join,
    "resolve_paths": q_resolve_paths,
    "pair_csv_rows": q_pair_csv_rows,
    "viewpoint_ids": q_viewpoint_ids,
}


from vantage.plans.round_trips import QUERIES as ROUND_TRIPS  # noqa: E402  (it reads the tables above)

QUERIES.update(ROUND_TRIPS)
