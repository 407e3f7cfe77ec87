"""COCO annotation files as three raw tables.

``read_coco_splits`` reads documents of any size: a document is cut into its
elements in parallel (``json_arrays``), each element is parsed once, and the
parsed elements are kept under the checkpoint folder, apart by section. Splits
are read one after another, and the text of a split's elements goes when they
are parsed.
``stage_coco`` writes them as Parquet tables for good. ``read_coco_document``
with ``raw_tables`` is the plain form for small documents, one task each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.operators.checks import RuleCounters
from vantage.schemas import COCO_ANNOTATION, COCO_CATEGORY, COCO_DOCUMENT, COCO_IMAGE
from vantage.session import free_scratch, scratch_path, shuffles_freed
from vantage.sources.json_arrays import parsed, read_sections

SECTIONS = {"images": COCO_IMAGE, "annotations": COCO_ANNOTATION, "categories": COCO_CATEGORY}
REQUIRED = {"images": True, "annotations": True, "categories": False}


def read_coco_document(spark: SparkSession, path: str) -> DataFrame:
    """One row per document; a document that doesn't parse fails the read."""
    return spark.read.schema(COCO_DOCUMENT).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def check_required_sections(doc: DataFrame) -> DataFrame:
    """Rows of documents lacking ``images`` or ``annotations`` (should be empty)."""
    # A sum, not a plain test: a test would be pushed into the reader, which then
    # stops at the first section and misses what is broken behind it.
    lacking = F.col("images").isNull().cast("int") + F.col("annotations").isNull().cast("int")
    return doc.where(lacking > 0).select(
        F.lit("missing images/annotations").alias("problem")
    )


def raw_tables(doc: DataFrame, split: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Explode one split's documents, read whole, into (images, annotations,
    categories). ``pos`` keeps the document order of every element; several
    documents of one split follow each other by path."""
    files = sorted(re.sub("^[a-z0-9]+:/*", "/", path) for path in doc.inputFiles())
    here = F.regexp_replace(F.col("_metadata.file_path"), "^[a-z0-9]+:/*", "/")
    nth = F.array_position(F.array(*map(F.lit, files)), here) - 1 if len(files) > 1 else F.lit(0)
    doc = doc.withColumn("_before", nth.cast("long") * F.lit(1 << 32))
    out = []
    for name, schema in SECTIONS.items():
        rows = doc.select("_before", F.posexplode(name).alias("pos", "e"))
        out.append(rows.select(F.lit(split).alias("split"), (F.col("_before") + F.col("pos")).alias("pos"),
                               *[F.col(f"e.{f}") for f in schema.names]))
    return tuple(out)


def _kept(df: DataFrame, name: str, *partition_by: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back; ``paths`` gets its path."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_coco_splits(spark: SparkSession, paths: dict[str, str] | Iterable[tuple[str, str]],
                     kept: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents of all splits as (images, annotations, categories), train
    first. A document without images or annotations, or one that isn't JSON, is
    an error. Several documents of a split follow each other by path. A split's
    documents are not read any more when the next of ``paths`` is taken.
    ``kept`` gets the scratch tables that the result reads."""
    element = [F.when(F.col("section") == name, parsed(F.col("text"), schema)).alias(f"e_{name}") for name, schema in SECTIONS.items()]
    elements = None
    for split, path in paths.items() if isinstance(paths, dict) else paths:
        pieces: list[str] = []
        found = read_sections(spark, path, REQUIRED, partial(_kept, paths=pieces))
        rows = _kept(found.select(F.lit(split).alias("split"), "pos", *element, "section"), "coco-elements", "section", paths=kept)
        free_scratch(spark, pieces)
        elements = rows if elements is None else elements.unionByName(rows)
    return tuple(
        elements.where(F.col("section") == name).select("split", "pos", f"e_{name}.*") for name in SECTIONS)


def box_rules() -> dict:
    """What a given box must satisfy, as conditions of a broken row."""
    given = F.col("bbox").isNotNull()
    return {"a box is not a list of four numbers": given & (
        (F.size("bbox") != 4) | F.exists("bbox", lambda x: x.try_cast("double").isNull()))}


def stage_coco(spark: SparkSession, paths: dict[str, str] | Iterable[tuple[str, str]], out_dir: str,
               partitions: int | None = None, strict: bool = False) -> dict[str, int]:
    """Writes the three tables as Parquet, counting rows and broken rules on
    the way, and last a record that the staging is whole. Returns the row
    counts; in strict mode broken rows are an error and leave the staging
    without record. ``partitions`` sets the number of files, else the elements stay where they
    were parsed. The parsed elements go when they are staged."""
    facts, kept = {}, []
    spark.createDataFrame([], "fact string, value long").write.mode("overwrite").parquet(f"{out_dir}/staged")
    for name, rows in zip(SECTIONS, read_coco_splits(spark, paths, kept)):
        rules = RuleCounters(f"stage-{name}", box_rules() if name == "annotations" else {})
        rows = rules.watch(rows.repartition(partitions) if partitions else rows)
        with shuffles_freed(spark):
            rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{out_dir}/{name}")
        if strict:
            rules.enforce(f"{out_dir}/{name}")
        facts[name] = rules.rows
    spark.createDataFrame(list(facts.items()), "fact string, value long").coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/staged")
    free_scratch(spark, kept)
    return facts


def read_staged(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tables ``stage_coco`` has written: images, annotations, categories.
    A staging that did not end well is an error."""
    if spark.read.schema("fact string, value long").parquet(f"{folder}/staged").isEmpty():
        raise ValueError(f"{folder}: the staging did not end")
    return tuple(spark.read.parquet(f"{folder}/{name}") for name in SECTIONS)
