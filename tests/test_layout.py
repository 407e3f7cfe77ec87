"""Clustered tables join without an exchange; ranks inside mostly small groups."""

import pytest
from pyspark.sql import functions as F

from vantage.operators.ranking import rank_mostly_small
from vantage.sources import layout as L
from vantage.sources.layout import hot_keys, open_clustered, write_clustered


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustered_tables_join_and_group_where_they_lie(spark, tmp_dir):
    rows = spark.range(2000).select((F.col("id") % 37).alias("k"), F.col("id").alias("a"))
    facts = spark.range(37).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    left = write_clustered(rows, f"{tmp_dir}/l", "k", 4, ("a",))
    right = write_clustered(facts, f"{tmp_dir}/r", "k", 4)
    joined = left.join(right.hint("merge"), "k").groupBy("k").agg(F.count("*").alias("n"), F.max("b").alias("b"))
    assert "Exchange" not in plan_of(joined)
    want = {k: (len(range(k, 2000, 37)), 2 * k) for k in range(37)}
    assert {r.k: (r.n, r.b) for r in joined.collect()} == want
    again = open_clustered(spark, f"{tmp_dir}/l", "k bigint, a bigint", "k", 4, ("a",))
    joined = again.join(right.hint("merge"), "k").groupBy("k").agg(F.count("*").alias("n"))
    assert "Exchange" not in plan_of(joined)
    assert {r.k: r.n for r in joined.collect()} == {k: n for k, (n, _) in want.items()}


def test_hot_keys(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("k"))
    assert [(r.k, r.rows) for r in hot_keys(rows, "k", 0.05).collect()] == [(7, 400)]


def skewed(spark):
    """Half of the rows under one key, some without a key."""
    key = F.when(F.col("id") < 600, 7).when(F.col("id") < 700, F.lit(None)).otherwise(F.col("id") % 50).cast("long")
    return spark.range(0, 1200, numPartitions=6).select(key.alias("k"), F.col("id").alias("a"))


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_hot_keys_lie_in_files_of_their_own(spark, tmp_dir, how):
    rows = skewed(spark)
    facts = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b")).unionByName(
        spark.createDataFrame([(None, 5), (7, 99)], "k long, b long"))
    hot = L.hot_keys_of([rows, facts], "k", 0.05)
    assert set(hot) == {7, None}
    left, right = (L.write_parts(df, f"{tmp_dir}/{how}{i}", "k", 4, hot) for i, df in enumerate((rows, facts)))
    assert left.hot.select(F.input_file_name()).distinct().count() == 6  # all tasks held such rows
    assert left.cold.where("k = 7 or k is null").isEmpty()
    got = L.join_parts(left, right, "k", how)
    want = rows.join(facts, "k", how)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(got.columns).collect()), key=repr)
    again = L.join_parts(L.open_parts(spark, f"{tmp_dir}/{how}0", "k bigint, a bigint", "k", 4), right, "k", how)
    assert again.count() == want.count()


def test_parts_group_without_moving_rows(spark, tmp_dir):
    """No exchange on the cold part; on the hot part only of partial sums."""
    rows = skewed(spark)
    facts = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
    hot = L.hot_keys_of([rows], "k", 0.05)
    left, right = L.write_parts(rows, f"{tmp_dir}/l", "k", 4, hot), L.write_parts(facts, f"{tmp_dir}/r", "k", 4, hot)
    seen = []

    def per_key(df):
        out = df.groupBy("k").agg(F.count("*").alias("n"), F.max("b").alias("b"))
        seen.append(plan_of(out))
        return out

    got = {r.k: (r.n, r.b) for r in L.join_parts(left, right, "k", then=per_key).collect()}
    keys = [7] * 600 + [i % 50 for i in range(700, 1200)]
    assert got == {k: (keys.count(k), 2 * k) for k in set(keys)}
    cold, hot_plan = seen
    assert "Exchange" not in cold
    assert "BroadcastHashJoin" in hot_plan and hot_plan.count("Exchange hashpartitioning") == 1


def test_no_hot_keys_and_empty_tables(spark, tmp_dir):
    none = skewed(spark).limit(0)
    assert L.hot_keys_of([none], "k") == []
    left = L.write_parts(none, f"{tmp_dir}/l", "k", 4, [])
    right = L.write_parts(skewed(spark), f"{tmp_dir}/r", "k", 4, [])
    assert L.join_parts(left, L.Parts(right.cold.withColumnRenamed("a", "b"), right.hot.withColumnRenamed("a", "b")), "k").isEmpty()
    assert right.hot.isEmpty() and right.cold.count() == 1200
    with pytest.raises(ValueError):
        L.hot_keys_of([none], "k", 0.0001)


@pytest.mark.parametrize("most", [3, 50, 10_000])
def test_rank_mostly_small(spark, most):
    rows = spark.range(500).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 40).alias("g"), F.xxhash64("id").alias("o"))
    got = [(r.g, r.o, r.place) for r in rank_mostly_small(rows, ["g"], ["o"], "place", most).collect()]
    groups = {}
    for r in rows.collect():
        groups.setdefault(r.g, []).append(r.o)
    assert sorted(got) == sorted((g, o, k) for g, os in groups.items() for k, o in enumerate(sorted(os)))
