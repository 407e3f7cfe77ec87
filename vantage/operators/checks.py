"""Data-quality checks. Each returns a DataFrame of violations (empty when
the data is sound); ``enforce`` turns a non-empty result into an error."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vantage.functions import vector_norm


class CheckFailed(ValueError):
    pass


def enforce(violations: DataFrame, message: str) -> None:
    if not violations.isEmpty():
        first = violations.first().asDict()
        raise CheckFailed(f"{message}: {first}")


class RuleCounters:
    """Counts broken rules, and rows, while a table passes to its sink: no pass
    of its own. ``rules`` maps a problem to the condition of a row that has it.

        rules = RuleCounters("images", {"no id": F.col("id").isNull()})
        rules.watch(images).write.parquet(path)
        rules.enforce("images")        # before the result is committed
    """

    def __init__(self, name: str, rules: dict[str, Column]):
        self.rules = rules
        self.seen = Observation(name)

    def watch(self, df: DataFrame) -> DataFrame:
        counts = [F.count(F.when(bad, 1)).alias(f"r{k}") for k, bad in enumerate(self.rules.values())]
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts)

    @property
    def rows(self) -> int:
        return self.seen.get["rows"]

    def broken(self) -> dict[str, int]:
        """Rows by broken rule; needs the watched table's action to have run."""
        found = self.seen.get
        return {p: found[f"r{k}"] for k, p in enumerate(self.rules) if found[f"r{k}"]}

    def enforce(self, message: str) -> None:
        if self.broken():
            raise CheckFailed(f"{message}: {self.broken()}")


def require_columns(df: DataFrame, columns: Iterable[str], exact: bool = False) -> None:
    """The header must contain (or, exact, equal) ``columns``."""
    cols = list(columns)
    if exact and df.columns != cols:
        raise CheckFailed(f"the header is {df.columns}, not {cols}")
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise CheckFailed(f"the table lacks {missing}")


def require_nonempty(df: DataFrame, what: str) -> None:
    """C2."""
    if df.isEmpty():
        raise CheckFailed(f"{what}: the table is empty")


def check_vectors(df: DataFrame, vec_col: str, dim: int, id_col: str = "seq") -> DataFrame:
    """C4: vectors of the wrong dimension or without a positive norm."""
    norm = vector_norm(vec_col)
    size = F.size(vec_col)
    bad = F.col(vec_col).isNull() | (size != dim) | norm.isNull() | (norm <= 0)
    return df.where(bad).select(id_col, size.alias("dim"), norm.alias("norm"))


def check_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def check_unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key has no row in ``right``."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def check_registry(registry: DataFrame, dim: int, last_index: int | None = None) -> DataFrame:
    """Registry rows without id, centroid or count, with a centroid of the
    wrong size, or a non-positive count; a negative last_index."""
    problem = (
        F.when(F.col("viewpoint_id").isNull(), F.lit("no id"))
        .when(F.col("centroid").isNull(), F.lit("no centroid"))
        .when(F.size("centroid") != dim, F.lit("centroid of another length"))
        .when(F.col("count").isNull(), F.lit("no count"))
        .when(F.col("count") <= 0, F.lit("count below one"))
    )
    out = registry.select("viewpoint_id", problem.alias("problem")).where(F.col("problem").isNotNull())
    if last_index is not None and last_index < 0:
        spark = registry.sparkSession
        out = out.unionByName(spark.createDataFrame([(None, "negative last index")],
                                                    "viewpoint_id long, problem string"))
    return out


def _problems(spark, rows: list[tuple[str, int, int | None]]) -> DataFrame:
    return spark.createDataFrame(rows, "problem string, rows long, first_seq long")


def check_resume(dataset: DataFrame, mapping: DataFrame, registry: DataFrame, last_index: int) -> DataFrame:
    """A saved state can resume only if the mapping is the dataset's first
    rows in order, ``last_index`` equals its length, and the registry counts
    sum to it. One row per failed rule: (problem, rows, first_seq)."""
    spark = dataset.sparkSession
    n, m = dataset.count(), mapping.count()
    c = int(registry.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("c")).first()["c"])
    found = []
    if m > n:
        found.append(("saved mapping is longer than the dataset", m - n, None))
    if last_index != m:
        found.append(("last index is not the number of mapped rows", abs(last_index - m), None))
    if c != m:
        found.append(("registry counts do not add up to the mapped rows", abs(c - m), None))
    head = _problems(spark, found)
    mism = (
        mapping.select("seq", F.col("image_id").alias("saved"))
        .join(dataset.select("seq", F.col("image_id").alias("expected")), "seq", "left")
        .where(F.col("expected").isNull() | (F.col("saved") != F.col("expected")))
        .agg(F.count(F.lit(1)).alias("rows"), F.min("seq").alias("first_seq"))
        .where(F.col("rows") > 0)
        .select(F.lit("saved mapping leaves the dataset order").alias("problem"), "rows", "first_seq")
    )
    return head.unionByName(mism)


def check_conservation(dataset: DataFrame, mapping: DataFrame, registry: DataFrame) -> DataFrame:
    """One mapping row per dataset row, registry counts summing to the
    dataset size and matching the rows mapped to each viewpoint, at least one
    viewpoint. One row per failed rule: (problem, rows).

    ``mapping`` and ``registry`` are read twice and once; pass written tables
    where they are costly. Two joins, each of pre-counted rows.
    """
    mapped = mapping.groupBy("seq").agg(F.count(F.lit(1)).alias("m"))
    rows = dataset.select("seq", F.lit(1).alias("d")).join(mapped, "seq", "full_outer").agg(
        F.count("d").alias("n"),
        F.count(F.when(F.col("m").isNull(), 1)).alias("missing"),
        F.coalesce(F.sum(F.greatest(F.col("m") - 1, F.lit(0))), F.lit(0)).alias("again"),
        F.count(F.when(F.col("d").isNull(), 1)).alias("foreign"),
    )
    per_vp = mapping.groupBy("viewpoint_id").agg(F.count(F.lit(1)).alias("mapped"))
    own = registry.select("viewpoint_id", F.col("count").alias("c"))
    views = own.join(per_vp, "viewpoint_id", "full_outer").agg(
        F.count("c").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("c"),
        F.count(F.when(F.coalesce("c", F.lit(0)) != F.coalesce("mapped", F.lit(0)), 1)).alias("differ"),
    )
    one = rows.crossJoin(views)  # one row each
    rules = {
        "no viewpoint": F.when(F.col("v") == 0, 1).otherwise(0),
        "registry counts do not add up to the dataset": F.abs(F.col("c") - F.col("n")),
        "dataset row without assignment": F.col("missing"),
        "dataset row assigned more than once": F.col("again"),
        "assignment of an unknown row": F.col("foreign"),
        "registry count differs from mapped rows": F.col("differ"),
    }
    found = F.explode(F.array(*[F.struct(F.lit(p).alias("problem"), n.cast("long").alias("rows")) for p, n in rules.items()]))
    return one.select(found.alias("x")).select("x.*").where(F.col("rows") > 0)
