"""Mixing sources to target weights.

Each source gets a word budget. Documents take a hash-random order inside
their source, running sums of their sizes are built from range buckets of that
order, and the mix is cut where the source's budget is spent: whole epochs
first, then documents in order, the last one in part, so that each source
gives its whole-number budget exactly.

DataFrame operations only. The prefix sum has two levels: sums per (source,
range bucket of the hash), then a window inside each bucket. Hashes are
uniform, so a source with a third of all rows spreads over all its buckets and
no task holds a whole source. Only tables of one row per source, or per
(source, bucket), are summed across buckets.

Defined results: a null text has size 0; a null source is a source of its own,
ordered last; documents without words are never taken; rows repeated with the
same id and size are interchangeable and ordered arbitrarily among themselves;
a row without id is hashed by its text; an empty table gives
an empty result. Extra columns are not read by ``mix`` and pass through
``take``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.llm.shared import SPACE, WORD, whole_text, with_locators, written


@dataclass(frozen=True)
class MixConfig:
    """``weights`` repeat over the sources in code point order, null last;
    ``share`` is the whole mix as a multiple of all words; no source gives
    more than ``max_epochs`` times its words. ``bucket_digits`` hex digits of
    the hash name a range bucket (16 ** digits buckets per source)."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    max_epochs: float = 2.0
    seed: str = "mix-1"
    bucket_digits: int = 3


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, cfg: MixConfig) -> DataFrame:
    """One row per source: source, source_size, target.

    A source whose weighted share passes its cap stops there and the excess
    goes to the others by weight. The fixed point is target = min(cap,
    level * weight): with sources ordered by cap / weight, the capped ones are
    a prefix of that order, so one running sum finds the level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(cfg.weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in cfg.weights]), (turn + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(cfg.max_epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole) * F.lit(cfg.share)
    left = budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    per = per.withColumn("level", left / F.sum("weight").over(rest))
    per = per.withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    first_open = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(whole)
    level = first_open["level"]
    target = F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, cfg: MixConfig = MixConfig(), keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target,
    taken (words of this document in the mix, repeats counted), hash_key, and
    the columns ``keep``, which also order rows that repeat an id."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(whole_text().cast("binary"))))
    key = F.md5(F.concat(F.lit(cfg.seed + ":"), name).cast("binary"))
    sizes = written(
        docs.select("doc_id", "source", size_of(whole_text()).alias("size"), key.alias("hash_key"), *keep),
        "mix-sizes",
    )
    targets = source_targets(sizes, cfg)
    bucket = F.substring("hash_key", 1, cfg.bucket_digits)
    sizes = sizes.withColumn("bucket", bucket)
    sums = sizes.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    targets = targets.withColumnRenamed("source", "t_source")
    offsets = sums.join(targets, F.col("source").eqNullSafe(F.col("t_source")), "left").select(
        F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), "ahead", "source_size", "target"
    )
    inside = Window.partitionBy("source", "bucket").orderBy("hash_key", "doc_id", "size", *keep)
    run = sizes.withColumn("run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket"))
    at = run.join(offsets, own, "left")
    start = F.col("ahead") + F.col("run") - F.col("size")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    left = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - start))
    taken = (epochs * F.col("size") + part).cast("long")
    return at.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "hash_key", *keep
    )


def take(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The mix as documents, same columns: a document stands once per epoch
    that takes it, and the one at the cut is shortened to its taken words
    (with the white space between them). Rows are told apart by their place in
    the files, so repeated ids keep to the budget."""
    rows = with_locators(docs)
    at = ("loc_file", "loc_row")
    plan = mix(rows.select("row.doc_id", "row.source", "row.text", *at), cfg, at).where(F.col("taken") > 0)
    hit = rows.join(plan.select(*at, F.col("size").alias("n"), "taken"), list(at))
    copies = F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("n")).cast("int") - 1)
    each = hit.select("row", "n", "taken", F.explode(copies).alias("epoch"))
    own = F.least(F.col("n"), F.col("taken") - F.col("epoch") * F.col("n"))
    pieces = F.regexp_extract_all("row.text", F.lit(f"({SPACE})?({WORD})"), F.lit(0))
    shortened = F.array_join(F.slice(pieces, 1, F.col("own").cast("int")), "")
    text = F.when(F.col("own") < F.col("n"), shortened).otherwise(F.col("row.text"))
    out = each.select("row", "n", own.alias("own")).select("row", text.alias("text"))
    new = {"text": F.col("text"), "n_chars": F.length("text")}
    return out.select(*[
        new[f.name].cast(f.dataType).alias(f.name) if f.name in new else F.col("row").getField(f.name).alias(f.name)
        for f in docs.schema.fields
    ])
