"""Near-duplicate viewpoint review: candidate rows with images, decisions,
progress, alignment checks and the CSV source/sink of the review files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.operators.ranking import rank_within_groups
from vantage.schemas import PAIR_COLUMNS, PAIR_CSV

DECISIONS = ("merge", "no_merge")


class ReviewFileError(ValueError):
    pass


def pairs_with_images(pairs: DataFrame, representatives: DataFrame, paths: DataFrame,
                      strict: bool = True) -> DataFrame:
    """Candidate rows: each pair with both viewpoints' first image and its path.

    ``pairs`` (id_a, id_b, similarity) is read twice (three times in strict
    mode): pass a written table where it is costly. ``strict`` raises when an
    image or a path is missing.
    """
    ids = pairs.select(F.explode(F.array("id_a", "id_b")).alias("viewpoint_id")).distinct()
    reps = representatives.select("viewpoint_id", "image_id").join(ids, "viewpoint_id", "left_semi")
    side = reps.join(paths.select("image_id", "path"), "image_id", "left")
    a = side.select(F.col("viewpoint_id").alias("id_a"), F.col("image_id").alias("image_id_a"),
                    F.col("path").alias("image_path_a"))
    b = side.select(F.col("viewpoint_id").alias("id_b"), F.col("image_id").alias("image_id_b"),
                    F.col("path").alias("image_path_b"))
    out = pairs.join(a, "id_a", "left").join(b, "id_b", "left").select(
        F.col("id_a").alias("viewpoint_id_a"), "image_id_a", "image_path_a",
        F.col("id_b").alias("viewpoint_id_b"), "image_id_b", "image_path_b",
        F.col("similarity").alias("centroid_similarity"),
        F.lit("").alias("merge_decision"), F.lit("").alias("notes"),
    )
    if strict:
        bad = out.where(F.col("image_path_a").isNull() | F.col("image_path_b").isNull())
        if not bad.isEmpty():
            raise ReviewFileError("a candidate pair has a viewpoint without image or file")
    return out


def with_candidate_order(candidates: DataFrame) -> DataFrame:
    """0-based row position of the candidate list: similarity desc, then ids
    (a distributed rank, the list may be long)."""
    keyed = candidates.withColumn("_down", -F.col("centroid_similarity"))
    return rank_within_groups(keyed, [], ["_down", "viewpoint_id_a", "viewpoint_id_b"], out="seq").drop("_down")


def apply_decisions(candidates: DataFrame, events: DataFrame, keep: bool = False) -> DataFrame:
    """Latest decision per pair (events: viewpoint_id_a, viewpoint_id_b,
    merge_decision, notes, event_seq) written onto the candidate rows; pairs
    without one get '' or, with ``keep``, keep theirs."""
    latest = events.groupBy("viewpoint_id_a", "viewpoint_id_b").agg(
        F.max_by(F.struct("merge_decision", "notes"), "event_seq").alias("d")
    )
    joined = candidates.join(latest, ["viewpoint_id_a", "viewpoint_id_b"], "left")
    new = {c: F.coalesce(F.col(f"d.{c}"), F.when(F.col("d").isNull() & F.lit(keep), F.col(c)), F.lit(""))
           for c in ("merge_decision", "notes")}
    return joined.withColumns(new).select(*candidates.columns)


def review_progress(decided: DataFrame) -> DataFrame:
    """Counts per decision and the index to resume at: the first row without
    merge/no_merge, or the row count when all are decided. Needs ``seq``."""
    done = F.col("merge_decision").isin(*DECISIONS)
    return decided.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("merge_decision") == "merge", 1)).alias("merge"),
        F.count(F.when(F.col("merge_decision") == "no_merge", 1)).alias("no_merge"),
        F.count(F.when(~done | F.col("merge_decision").isNull(), 1)).alias("undecided"),
        F.coalesce(F.min(F.when(~done | F.col("merge_decision").isNull(), F.col("seq"))),
                   F.count(F.lit(1))).alias("resume_index"),
    )


def check_alignment(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows where the decision file does not line up with the candidate file
    (by position): missing on either side, or different viewpoint ids."""
    c = candidates.select("seq", F.col("viewpoint_id_a").alias("ca"), F.col("viewpoint_id_b").alias("cb"))
    d = decisions.select("seq", F.col("viewpoint_id_a").alias("da"), F.col("viewpoint_id_b").alias("db"))
    j = c.join(d, "seq", "full_outer")
    problem = (
        F.when(F.col("ca").isNull(), F.lit("extra decision row"))
        .when(F.col("da").isNull(), F.lit("missing decision row"))
        .when(F.col("ca") != F.col("da"), F.lit("viewpoint_id_a mismatch"))
        .when(F.col("cb") != F.col("db"), F.lit("viewpoint_id_b mismatch"))
    )
    return j.select("seq", problem.alias("problem")).where(F.col("problem").isNotNull())


def read_pair_csv(spark: SparkSession, path: str) -> DataFrame:
    """Candidate / decision CSV: exact 9-column header, at least one row.
    Doubled quotes are the escape, as the csv module writes them."""
    raw = spark.read.option("header", "true").option("escape", '"').csv(path)
    if tuple(raw.columns) != PAIR_COLUMNS:
        raise ReviewFileError(f"{path}: the header is not that of a review file")
    if raw.isEmpty():
        raise ReviewFileError(f"{path}: no candidate rows")
    from vantage.sources.mapping import with_file_order

    typed = with_file_order(spark.read.schema(PAIR_CSV).option("header", "true").option("escape", '"').csv(path))
    return typed.select(
        F.col("viewpoint_id_a").cast("long"), "image_id_a", "image_path_a",
        F.col("viewpoint_id_b").cast("long"), "image_id_b", "image_path_b",
        F.col("centroid_similarity").cast("double"),
        F.coalesce("merge_decision", F.lit("")).alias("merge_decision"),
        F.coalesce("notes", F.lit("")).alias("notes"),
        "seq",
    )


def pair_csv_rows(candidates: DataFrame) -> DataFrame:
    """Text columns as written to the review file (similarity as %.6f)."""
    return candidates.select(
        *[F.format_string("%.6f", F.col(c)).alias(c) if c == "centroid_similarity" else F.col(c).cast("string")
          for c in PAIR_COLUMNS]
    )


def write_pair_csv(candidates: DataFrame, path: str) -> None:
    """The rows in their file order (``seq``) where they have one, else by
    similarity and ids."""
    order = ["seq"] if "seq" in candidates.columns else [F.col("centroid_similarity").desc(), "viewpoint_id_a", "viewpoint_id_b"]
    pair_csv_rows(candidates.orderBy(*order)).write.mode("overwrite").option("header", "true") \
        .option("escape", '"').option("emptyValue", "").csv(path)
