"""Exact deduplication with streaming state.

Rows stream through a keyed aggregation whose state lives on disk (RocksDB)
and never expires. Per digest the state holds the number of rows, the stable
identifier (smallest document id) and the content locator of that row (file
and row index in the file). Further rows can be streamed into the same state
later: ``absorb`` takes up where the last run ended.

Digest hits are then checked on full bytes: the texts of all rows whose digest
occurs twice or more are compared through the smallest and the largest text of
the group, which partial aggregation folds before the shuffle, so a group
holding a third of all rows sends one row per task. Should a digest ever cover
different texts, its rows are grouped again by the whole text.

Texts are equal when identical after each run of ASCII white space becomes one
space. Defined results: null counts as empty; a null id is never the stable
identifier unless the group has no other; of rows repeated with the same id
and text exactly one (the first by locator) stays; an empty table gives an
empty result; extra columns are not read. Input that does not come straight
from files is first written to the shared folder, so that it has locators.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm.shared import SPACE, join_split, whole_text, written
from vantage.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The state's settings: on disk, without space set aside per store (many small
# stores would hold several MB each), and with one bound on the memory that all
# stores of an executor share.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    # Executors unload the stores of an ended stream at the next maintenance.
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
}
# State of one partition stays small, its count is fixed for the life of the
# state: rows per partition, and the most partitions one state may have.
STATE_ROWS = 2_000_000
MAX_STATE_PARTITIONS = 2_000


def normalised(column: str = "text"):
    return F.regexp_replace(whole_text(column), SPACE, " ")


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with its rows' locators: loc_file, loc_row."""
    try:
        return docs.select("doc_id", "text", F.col("_metadata.file_path").alias("loc_file"), F.col("_metadata.row_index").alias("loc_row"))
    except AnalysisException:
        return located(written(docs.select("doc_id", "text"), "dedup-input"))


def absorb(spark: SparkSession, folder: str, state: str, schema, partitions: int) -> DataFrame:
    """Stream the rows of ``folder`` not seen yet into the state at ``state``;
    returns the whole state: digest, group_size, first (doc_id, loc_file,
    loc_row)."""
    conf = STATE_CONF | {"spark.sql.shuffle.partitions": str(partitions)}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = spark.readStream.schema(schema).parquet(folder)
        first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "loc_file", "loc_row")
        keyed = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min(first).alias("first"))
        keyed.writeStream.format("noop").outputMode("update").option("checkpointLocation", state).trigger(
            availableNow=True
        ).start().awaitTermination()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    kept = spark.read.format("statestore").load(state)
    size, first = (f.name for f in kept.schema["value"].dataType.fields)
    return kept.select("key.digest", F.col(f"value.{size}").alias("group_size"), F.col(f"value.{first}").alias("first"))


def decisions(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, loc_file, loc_row, keep_id,
    group_size, kept, text_sha256."""
    spark = docs.sparkSession
    rows = located(docs)
    digest = F.unhex(F.sha2(normalised(), 256))
    narrow = written(rows.select("doc_id", "loc_file", "loc_row", digest.alias("digest")), "dedup-rows")
    total = narrow.count()
    parts = max(1, min(MAX_STATE_PARTITIONS, total // STATE_ROWS + 6))
    folder = narrow.inputFiles()[0].rsplit("/", 1)[0] if total else None
    if folder is None:
        return narrow.select(
            "doc_id", "loc_file", "loc_row", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
        )
    state = written(absorb(spark, folder, scratch_path(spark, "dedup-state"), narrow.schema, parts), "dedup-seen")
    hits = state.where("group_size > 1").select("digest", "group_size")

    dup = join_split(narrow, hits, "digest", "group_size", total).where("group_size is not null").select("loc_file", "loc_row", "digest")
    texts = rows.join(dup, ["loc_file", "loc_row"]).withColumn("norm", normalised())
    folded = texts.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    clash = written(folded.where("lo <> hi").select("digest"), "dedup-clash")

    same = join_split(narrow, state.select("digest", "group_size", "first"), "digest", "group_size", total)
    out = _decided(same.join(clash, "digest", "left_anti"))
    if clash.isEmpty():
        return out
    again = texts.join(clash, "digest", "left_semi")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "loc_file", "loc_row")
    groups = again.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("group_size"), F.min(first).alias("first"))
    return out.unionByName(_decided(again.drop("text").join(groups, ["digest", "norm"])))


def _decided(rows: DataFrame) -> DataFrame:
    kept = (F.col("loc_file") == F.col("first.loc_file")) & (F.col("loc_row") == F.col("first.loc_row"))
    return rows.select(
        "doc_id", "loc_file", "loc_row", F.col("first.doc_id").alias("keep_id"), "group_size",
        kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, all columns."""
    try:
        rows = docs.select(
            F.struct(*docs.columns).alias("row"), F.col("_metadata.file_path").alias("loc_file"),
            F.col("_metadata.row_index").alias("loc_row"),
        )
    except AnalysisException:
        return deduplicated(written(docs, "dedup-docs"))
    kept = decisions(docs).where("kept").select("loc_file", "loc_row")
    return rows.join(kept, ["loc_file", "loc_row"], "left_semi").select("row.*")
