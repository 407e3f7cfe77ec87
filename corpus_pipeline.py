"""Corpus pipeline over the documents table.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and reread as the next
stage's docs. ``run`` applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vantage.llm import exact_dedup, mixing, packing, quality_rules, simhash
from vantage.llm.shared import documents, written


# Text goes to Python in Arrow batches of about this size. Spark's own bound is a
# number of rows, which is memory without bound where texts are long.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that lose too much or fail the base limits."""
    small_batches(spark)
    return quality_rules.clean(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (three-word shingles, three bits)."""
    small_batches(spark)
    return simhash.one_per_group(docs, simhash.SimHashConfig(shingle_words=3, max_bits=3))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words each source's budget pays for; repeated documents stand once per epoch."""
    return mixing.take(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2,048 ids. The word cache is half
    the usual size: workers keep it while other stages run."""
    small_batches(spark)
    return packing.pack(docs, packing.PackConfig(cache_words=500_000))


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("simhash", near),
    ("mix_sources", mixture),
    ("packing", pack),
]

# Near-duplicate grouping and tokenised packing have no SQL form; the stages are
# tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
