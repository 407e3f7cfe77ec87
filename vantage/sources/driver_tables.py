"""Domain tables derived from the driver's TPC-H-like Parquet tables.

The test driver ships no COCO files, so the raw COCO tables, the mapping and
the embeddings are defined as deterministic projections of its tables:

  mapping      orders:   image_id = o_orderkey as text, viewpoint_id = o_custkey, seq = o_orderkey
  images       orders:   split = 'val' when o_orderstatus = 'F' else 'train',
                         id = o_orderkey, file_name = '<split>/<o_orderkey>.png',
                         width = floor(o_totalprice / 100), height = 100, pos = o_orderkey
  annotations  lineitem: id = l_orderkey * 8 + l_linenumber, image_id = l_orderkey,
                         category_id = l_partkey, bbox = [0, 0, l_quantity, l_linenumber],
                         area = null when l_returnflag = 'A' else l_quantity * 10, pos = l_linenumber
  categories   part:     id = p_partkey, name = p_name
  embeddings   embeddings: seq = vec_id, image_id = vec_id as text, embedding, label

Order keys are unique across both splits, so the annotation table needs no
split column: it joins its image on ``coco_image_id`` alone (with a split
column the join key is (split, coco_image_id)).

Only the columns each view needs are selected, so the Parquet scans prune.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.sources.mapping import MAPPING_COLUMNS

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Keyword rules for the part names of the driver tables (the vehicle keyword
# lists match none of them). Class names look like "red plate", "old rod".
DRIVER_HEAVY_KEYWORDS = ("gear", "anvil", "plate")
DRIVER_TWO_WHEELER_KEYWORDS = ("ring", "rod")

# Similarity thresholds for the driver's 64-d random unit vectors; the
# application's 0.97 / 0.90 select nothing on them.
DRIVER_PAIR_THRESHOLD = 0.40


# Read schemas of the driver columns the views use. A declared schema skips
# the footer-reading job that inference costs on every read, and reads only
# these columns.
READ_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string",
    "part": "p_partkey bigint, p_name string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = READ_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _split_of(status: F.Column) -> F.Column:
    return F.when(status == "F", F.lit("val")).otherwise(F.lit("train"))


def raw_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    split = _split_of(F.col("o_orderstatus"))
    return o.select(
        split.alias("split"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderkey").alias("id"),
        F.concat(split, F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".png")).alias("file_name"),
        F.floor(F.col("o_totalprice") / 100).cast("double").alias("width"),
        F.lit(100.0).alias("height"),
    )


def raw_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linenumber").cast("long").alias("pos"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("image_id"),
        F.col("l_partkey").alias("category_id"),
        F.when(F.col("l_returnflag") == "A", F.lit(None).cast("double"))
        .otherwise(F.col("l_quantity") * 10).alias("area"),
        F.array(F.lit(0.0), F.lit(0.0), F.col("l_quantity").cast("double"),
                F.col("l_linenumber").cast("double")).alias("bbox"),
    )


def raw_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("pos"), F.col("p_partkey").alias("id"),
                    F.col("p_name").alias("name"))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("image_id"),
        F.col("o_custkey").cast("long").alias("viewpoint_id"),
        F.col("o_orderkey").cast("long").alias("seq"),
    )


def mapping_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping as the CSV sources see it: the two text columns only."""
    return mapping(spark, sf_dir).select(*MAPPING_COLUMNS)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("long").alias("seq"),
        F.col("vec_id").cast("string").alias("image_id"),
        F.col("embedding"),
        F.col("label").cast("long").alias("label"),
    )


def embedding_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry-shaped table with one viewpoint per embedding row
    (viewpoint_id = vec_id): the input of the near-duplicate search."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("long").alias("viewpoint_id"), F.col("embedding").alias("centroid"),
                    F.lit(1).cast("long").alias("count"))


VECTOR_DIMS = 64


def centroids_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry-shaped table: one unit centroid per embedding label. The
    means of all dimensions are one aggregate, combined before the shuffle."""
    from vantage.functions import l2_normalize

    e = embeddings(spark, sf_dir)
    mean = F.array(*[F.avg(F.get("embedding", F.lit(i)).cast("double")) for i in range(VECTOR_DIMS)])
    means = e.groupBy("label").agg(mean.alias("m"), F.count(F.lit(1)).alias("count"))
    return means.select(F.col("label").alias("viewpoint_id"), l2_normalize("m").alias("centroid"), "count")


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(viewpoint_id, count) of the label registry, without its centroids."""
    return embeddings(spark, sf_dir).groupBy(F.col("label").alias("viewpoint_id")).agg(F.count(F.lit(1)).alias("count"))
