"""Joins without hot keys, connected components, word numbering."""

import random

from pyspark.sql import functions as F

from vantage.llm.components import connected_components
from vantage.llm.shared import END, join_split, numbered_words


def test_join_split_equals_a_left_join(spark):
    rng = random.Random(1)
    data = [(i, rng.choice(["hot"] * 6 + ["warm"] * 2 + [f"k{i}"]) if i % 9 else None) for i in range(900)]
    rows = spark.createDataFrame(data, "id long, key string")
    sizes = rows.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("key <> 'k7'")
    table = sizes.withColumn("v", F.length("key"))
    want = sorted(map(repr, rows.join(table, "key", "left").select("id", "key", "n", "v").collect()))
    for share in (1e-9, 0.1, 2.0):  # every key hot, some, none
        got = join_split(rows, table, "key", "n", 900, share)
        assert sorted(map(repr, got.collect())) == want
    empty = join_split(rows, table.limit(0), "key", "n", 900)
    assert empty.count() == 900 and empty.where("v is not null").count() == 0


def test_join_split_on_a_struct_key(spark):
    rows = spark.createDataFrame([(i, i % 3, "x") for i in range(30)], "id long, a long, b string")
    rows = rows.select("id", F.struct("a", "b").alias("key"))
    table = spark.createDataFrame([(0, "x", 10, "zero"), (1, "x", 2, "one")], "a long, b string, n long, name string")
    table = table.select(F.struct("a", "b").alias("key"), "n", "name")
    got = {r.id: r.name for r in join_split(rows, table, "key", "n", 30, 0.2).collect()}
    assert got == {i: {0: "zero", 1: "one"}.get(i % 3) for i in range(30)}


def brute(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_components(spark):
    rng = random.Random(4)
    chain = list(range(120))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:]))  # one path in any order
    edges += [(1000, 1000 + rng.randint(1, 200)) for _ in range(150)]  # a hub
    edges += [(rng.randint(2000, 2080), rng.randint(2000, 2080)) for _ in range(60)]
    edges += [(-5, -9), (7000, -9), (-5, -9)]
    edges = [(a, b) for a, b in edges if a != b]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == brute(edges)


def test_components_of_nothing(spark):
    none = spark.createDataFrame([], "u long, v long")
    assert connected_components(none).count() == 0
    assert connected_components(spark.createDataFrame([(3, 3)], "u long, v long")).count() == 0


def test_numbered_words():
    words, at = numbered_words([b"a b\ta", b"", b" c\x0b a "])
    assert [words[i] for i in at] == [b"a", b"b", b"a", END, END, b"c", b"a", END]
    assert numbered_words([])[1].tolist() == []


def test_spread_text(spark):
    from vantage.llm.shared import spread_text

    words = " ".join(f"w{i}" for i in range(1000))
    rows = spark.createDataFrame([("short one",), (words,), ("x" * 5000,), ("",), (None,)], "t string")
    got = [r[0] for r in rows.select(spread_text("t", 80)).collect()]
    assert got[0] == "short one" and got[3] == "" and got[4] is None
    picked = got[1].split()
    assert set(picked) <= set(words.split()) and picked[0] == "w0" and picked[-1] == "w999"
    places = [int(w[1:]) for w in picked]
    assert places == sorted(places) and max(b - a for a, b in zip(places, places[1:])) < 200 and len(got[1]) <= 88
    assert len(got[2]) <= 88
