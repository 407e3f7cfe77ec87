"""Writers. Ordered outputs are range-partitioned and sorted, so part files
are in order and no single task writes everything; only bounded outputs
(previews, the capped pair list) are written as one file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.constants import PREVIEW_LIMIT
from vantage.session import shuffles_freed

CSV_OPTIONS = {"header": "true", "escape": '"', "emptyValue": ""}


def _csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_mapping_csv(mapping: DataFrame, path: str) -> None:
    """Mapping CSV (image_id, viewpoint_id) in ``seq`` order."""
    _csv(mapping.orderBy("seq").select("image_id", "viewpoint_id"), path)


def write_metrics_parquet(metrics: DataFrame, path: str) -> None:
    """Viewpoint metrics sorted by viewpoint id (range partitioned)."""
    metrics.orderBy(F.col("viewpoint_id").asc()).write.mode("overwrite").parquet(path)


def write_preview_jsonl(metrics: DataFrame, path: str, limit: int = PREVIEW_LIMIT) -> None:
    """First max(1, limit) rows by viewpoint as one JSON-lines file; null
    fields are left out of each record. The rows never reach the driver."""
    preview = metrics.orderBy(F.col("viewpoint_id").asc()).limit(max(1, int(limit)))
    preview.coalesce(1).write.mode("overwrite").json(path)


# --- lists of any length --------------------------------------------------
#
# A list is written in pieces of CHUNK_VALUES values, one row a piece, so no
# row, buffer or task holds a whole list. The pieces of a key stand in one file
# in order: they are sorted by (key, piece) in the task that streams them out.

CHUNK_VALUES = 10_000


def list_pieces(members: DataFrame, key: str, value: str, chunk: int = CHUNK_VALUES) -> DataFrame:
    """(key, piece, body): the values of each key, by ``position``, as JSON
    text without the brackets, ``chunk`` values a row."""
    rows = members.select(key, F.floor(F.col("position") / chunk).alias("piece"), "position", value)
    lists = rows.groupBy(key, "piece").agg(F.sort_array(F.collect_list(F.struct("position", value))).alias("l"))
    text = F.to_json(F.transform("l", lambda e: e[value]))
    return lists.select(key, "piece", F.substring(text, F.lit(2), F.length(text) - 2).alias("body"))


def _laid_out(heads: DataFrame, pieces: DataFrame, key: str, count: str, chunk: int) -> DataFrame:
    """The pieces with their key's columns, sorted; a key without values keeps
    one empty piece. Adds ``first`` and ``last``."""
    rows = heads.join(pieces, key, "left").select(
        *heads.columns, F.coalesce("piece", F.lit(0)).alias("piece"), F.coalesce("body", F.lit("")).alias("body"))
    rows = rows.withColumn("first", F.col("piece") == 0).withColumn(
        "last", F.col("piece") >= F.floor((F.col(count) - 1) / chunk))
    return rows.repartitionByRange(key).sortWithinPartitions(key, "piece")


def write_list_jsonl(heads: DataFrame, members: DataFrame, key: str, value: str, count: str, field: str, path: str,
                     chunk: int = CHUNK_VALUES) -> None:
    """JSON lines: the columns of ``heads`` and the list ``field``. A blank
    stands between pieces, also at the begin of a line, where JSON allows it."""
    rows = _laid_out(heads, list_pieces(members, key, value, chunk), key, count, chunk)
    head = F.to_json(F.struct(*heads.columns), {"ignoreNullFields": "false"})
    begin = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(f',"{field}":['))
    text = F.concat(F.when(F.col("first"), begin).otherwise(","), "body", F.when(F.col("last"), "]}\n").otherwise(""))
    rows.select(text.alias("value")).write.mode("overwrite").option("lineSep", " ").text(path)


def write_list_csv(heads: DataFrame, members: DataFrame, key: str, value: str, count: str, field: str, path: str,
                   chunk: int = CHUNK_VALUES) -> None:
    """CSV with the list as JSON text in its last column. A list of more than
    ``chunk`` values goes on in a new line inside its quotes (read it with
    ``multiLine``); all others stand in one line."""
    rows = _laid_out(heads, list_pieces(members, key, value, chunk), key, count, chunk)
    begin = F.concat(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in heads.columns]), F.lit(',"['))
    body = F.replace("body", F.lit('"'), F.lit('""'))
    text = F.concat(F.when(F.col("first"), begin).otherwise(","), body, F.when(F.col("last"), ']"').otherwise(""))
    header = ",".join([*heads.columns, field])

    def headed(batches):
        import pyarrow as pa

        for k, b in enumerate(batches):
            if k == 0 and len(b):
                yield pa.RecordBatch.from_arrays([pa.array([header], b.schema.field(0).type)], schema=b.schema)
            yield b

    rows.select(text.alias("value")).mapInArrow(headed, "value string").write.mode("overwrite").text(path)


def write_grouped(ranks: DataFrame, sizes: DataFrame, out_dir: str, chunk: int = CHUNK_VALUES) -> None:
    """Each viewpoint's ordered image list as JSON lines and as CSV, from the
    numbered rows (``mapping_ranks``) and (viewpoint_id, image_count)."""
    args = (sizes.select("viewpoint_id", "image_count"), ranks, "viewpoint_id", "image_id", "image_count")
    write_list_jsonl(*args, "image_ids", f"{out_dir}/viewpoint_to_images_jsonl", chunk)
    write_list_csv(*args, "image_ids_json", f"{out_dir}/viewpoint_to_images_csv", chunk)


def write_bucket_files(assignment: DataFrame, totals: DataFrame, members: DataFrame, out_dir: str,
                       chunk: int = CHUNK_VALUES) -> None:
    """The assignment, and each bucket's totals with its viewpoint list, from
    (bucket_id, viewpoint_count, image_count) and ``bucket_members``."""
    _csv(assignment.orderBy("bucket_id", "viewpoint_id").select("viewpoint_id", "bucket_id", "image_count"),
         f"{out_dir}/viewpoint_bucket_assignment")
    write_list_csv(totals.select("bucket_id", "viewpoint_count", "image_count"), members, "bucket_id", "viewpoint_id",
                   "viewpoint_count", "viewpoint_ids_json", f"{out_dir}/bucket_summary", chunk)


def write_coco(images: DataFrame, annotations: DataFrame, categories: DataFrame, path: str, documents: int = 1) -> None:
    """Raw COCO tables as JSON documents, one file each: images and their
    annotations are dealt by image id, the categories are in every document.
    Elements follow ``pos``; null fields are left out. A document is streamed
    by a task of its own."""
    fields = lambda df: F.to_json(F.struct(*[c for c in df.columns if c != "pos"]))
    deal = lambda c: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(documents)).cast("int").alias("document")
    each = F.explode(F.sequence(F.lit(0), F.lit(documents - 1))).alias("document")
    rows = images.select(deal("id"), F.lit(0).alias("section"), "pos", fields(images).alias("value"))
    rows = rows.unionByName(annotations.select(deal("image_id"), F.lit(1).alias("section"), "pos", fields(annotations).alias("value")))
    rows = rows.unionByName(categories.select(each, F.lit(2).alias("section"), "pos", fields(categories).alias("value")))
    # the frame of each document: its begin, the steps between sections, its end
    frame = images.sparkSession.createDataFrame(
        [(0, '{"images": ['), (1, '], "annotations": ['), (2, '], "categories": ['), (3, "]}")], "section int, value string")
    rows = rows.unionByName(frame.select(each, "section", F.lit(-1).cast("long").alias("pos"), "value"))

    def commas(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last = (-1, -1)  # document and section of the element before, -1 where none
        for b in batches:
            if not len(b):
                continue
            document, section, pos = (c.to_numpy(zero_copy_only=False) for c in b.columns[:3])
            element = pos >= 0
            here = np.where(element, document, -1), np.where(element, section, -1)
            before = [np.concatenate([[x], h[:-1]]) for x, h in zip(last, here)]
            again = element & (before[0] == here[0]) & (before[1] == here[1])
            comma = pc.if_else(pa.array(again), ",", "")
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(comma, b.column(3), "")], names=["value"])
            last = int(here[0][-1]), int(here[1][-1])

    laid = rows.repartitionById(documents, F.col("document")).sortWithinPartitions("document", "section", "pos", "value")
    with shuffles_freed(images.sparkSession):
        laid.select("document", "section", "pos", "value").mapInArrow(commas, "value string").write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
