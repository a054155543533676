"""Operator semantics and properties: versions, surrogate keys, lookups."""

import datetime as d
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tierforge.operators import (
    current_only,
    end_date_versions,
    keep_latest,
    lookup,
    surrogate_key,
)


def _sorted(rows):
    return sorted(tuple("~" if v is None else str(v) for v in r) for r in rows)


def test_keep_latest_literal(spark):
    day = d.date(2020, 1, 1)
    rows = [(1, day, "a"), (1, day, "b"), (1, None, "c"), (2, None, "d"), (2, None, "e"), (None, day, "f"),
            (0, day, "g")]
    df = spark.createDataFrame(rows, "id int, dt date, tag string")
    got = keep_latest(df.where(F.col("id") > 0), "id", "dt")
    assert sorted(r.tag for r in got.collect()) == ["a", "b", "d", "e"]
    # without the id filter the null key is its own group, as in a window
    assert sorted(r.tag for r in keep_latest(df, "id", "dt").collect()) == ["a", "b", "d", "e", "f", "g"]


def test_keep_latest_matches_dense_rank(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else rng.randint(1, 200)           # key 0 holds a third of all rows
        day = None if rng.random() < 0.1 else d.date(2020, 1, 1) + d.timedelta(days=rng.randint(0, 20))
        rows.append((key, day, i))
    rows += [(None, None, 10_000), (None, d.date(2020, 1, 1), 10_001)]
    df = spark.createDataFrame(rows, "k int, dt date, i int")
    w = Window.partitionBy("k").orderBy(F.col("dt").desc())
    expected = df.withColumn("r", F.dense_rank().over(w)).where("r = 1").drop("r")
    got = keep_latest(df, "k", "dt")
    assert _sorted(got.collect()) == _sorted(expected.collect())
    # idempotent
    assert _sorted(keep_latest(got, "k", "dt").collect()) == _sorted(got.collect())


def test_keep_latest_first(spark):
    day = d.date(2020, 1, 1)
    df = spark.createDataFrame([(1, day, "b"), (1, day, "a"), (2, None, "z"), (2, None, "y")], "k int, dt date, t string")
    got = keep_latest(df, "k", "dt", ties="first", tie_breaker="t")
    assert sorted((r.k, r.t) for r in got.collect()) == [(1, "a"), (2, "y")]


def test_end_date_literal(spark):
    rows = [(1, "A-x", d.date(2020, 1, 1)), (2, "A-x", d.date(2021, 1, 1)), (3, "B-x", d.date(2020, 6, 1))]
    df = spark.createDataFrame(rows, "id int, k string, s date")
    got = {r.id: r.e for r in end_date_versions(df, "k", "s", ["id"], "e").collect()}
    assert got == {1: d.date(2020, 12, 31), 2: None, 3: None}


def _versions(spark):
    rng = random.Random(11)
    rows = []
    for i in range(4000):
        key = "hot" if i % 2 == 0 else f"k{rng.randint(0, 60)}"      # one key holds half of the rows
        start = None if rng.random() < 0.05 else d.date(2015, 1, 1) + d.timedelta(days=rng.randint(0, 400))
        rows.append((i, key, start))
    rows += [(90_000, None, d.date(2016, 1, 1)), (90_001, None, d.date(2016, 2, 1))]
    return spark.createDataFrame(rows, "id int, k string, s date")


def test_end_date_split_equals_window(spark):
    df = _versions(spark)
    w = Window.partitionBy("k").orderBy(F.col("s").asc_nulls_first(), "id")
    expected = df.withColumn("e", F.date_sub(F.lead("s").over(w), 1))
    for partitions in (1, 2, 7, 64, 400):
        got = end_date_versions(df, "k", "s", ["id"], "e", partitions=partitions)
        assert _sorted(got.collect()) == _sorted(expected.collect()), partitions


def test_end_dated_intervals_do_not_overlap(spark):
    # a null start has no successor date, so the property is stated for dated versions
    dated = end_date_versions(_versions(spark).where(F.col("s").isNotNull()), "k", "s", ["id"], "e", partitions=5)
    bad = (dated.where(F.col("s").isNotNull() & F.col("e").isNotNull())
                .where(F.col("e") < F.date_sub(F.col("s"), 1)))
    assert bad.count() == 0
    assert current_only(dated, "e").groupBy("k").count().where("count > 1").count() == 0


def test_surrogate_key_ranged_equals_global(spark):
    rng = random.Random(3)
    rows = [(None if i % 50 == 0 else (5 if i % 3 == 0 else rng.randint(0, 10_000)), f"n{i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "a int, b string")
    glob = surrogate_key(df, ["a", "b"], "key", method="global")
    ranged = surrogate_key(df, ["a", "b"], "key", method="ranged", rows_per_bucket=300)
    assert _sorted(ranged.collect()) == _sorted(glob.collect())
    keys = [r.key for r in ranged.collect()]
    assert sorted(keys) == list(range(1, len(rows) + 1))
    assert ranged.schema["key"].dataType.simpleString() == "bigint"


def test_surrogate_key_ranged_plan_has_no_single_partition(spark):
    df = spark.range(0, 5000).withColumn("b", F.col("id") % 7)
    ranged = surrogate_key(df, ["b", "id"], "key", method="ranged", rows_per_bucket=500)
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    glob = surrogate_key(df, ["b", "id"], "key", method="global")       # the older name numbers the same way
    assert "SinglePartition" not in glob._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.key for r in glob.collect()) == list(range(1, 5001))


def test_surrogate_key_auto_numbers_from_one(spark):
    df = spark.range(0, 10)
    assert [r.key for r in surrogate_key(df, "id", "key", method="auto").orderBy("id").collect()] == list(range(1, 11))
    assert [r.key for r in surrogate_key(df, "id", "key").orderBy("id").collect()] == list(range(1, 11))


def test_lookup_semantics(spark):
    left = spark.createDataFrame([(1, " a "), (2, "b"), (3, None), (4, "z")], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("b", 20), ("b", 21), (None, 99)], "k2 string, v int")
    got = lookup(left, right, ("k", "k2"), {"v": "val"}, normalize=F.trim)
    assert _sorted(got.select("id", "val").collect()) == _sorted([(1, 10), (2, 20), (2, 21), (3, None), (4, None)])
    plain = lookup(left, right, ("k", "k2"), {"v": "val"})
    assert _sorted(plain.select("id", "val").collect()) == _sorted([(1, None), (2, 20), (2, 21), (3, None),
                                                                    (4, None)])
    assert plain.columns == ["id", "k", "val"]
    try:
        lookup(left, right, ("k", "k2"), {"v": "id"})
        raise AssertionError("name clash not detected")
    except ValueError:
        pass


def test_operators_accept_empty_inputs(spark):
    empty = spark.createDataFrame([], "k int, s date, i int")
    assert keep_latest(empty, "k", "s").count() == 0
    assert keep_latest(empty, "k", "s", ties="first", tie_breaker="i").count() == 0
    assert end_date_versions(empty, "k", "s", ["i"], "e").columns == ["k", "s", "i", "e"]
    assert end_date_versions(empty, "k", "s", ["i"], "e", partitions=3).count() == 0
    for method in ("global", "ranged", "auto"):
        keyed = surrogate_key(empty, ["k", "i"], "key", method=method)
        assert keyed.count() == 0 and keyed.columns == ["key", "k", "s", "i"]
    right = spark.createDataFrame([], "k2 int, v int")
    assert lookup(empty, right, ("k", "k2"), {"v": "val"}).count() == 0


def test_end_date_split_with_a_composite_key(spark):
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        a = "hot" if i % 2 == 0 else rng.choice(["x", "y", None])
        b = 1 if i % 2 == 0 else rng.choice([1, 2, None])
        start = None if rng.random() < 0.05 else d.date(2018, 1, 1) + d.timedelta(days=rng.randint(0, 300))
        rows.append((i, a, b, start))
    df = spark.createDataFrame(rows, "id int, a string, b int, s date")
    w = Window.partitionBy("a", "b").orderBy(F.col("s").asc_nulls_first(), "id")
    expected = df.withColumn("e", F.date_sub(F.lead("s").over(w), 1))
    got = end_date_versions(df, ["a", "b"], "s", ["id"], "e", partitions=40)
    assert _sorted(got.collect()) == _sorted(expected.collect())
    got = keep_latest(df, ["a", "b"], "s")
    wk = Window.partitionBy("a", "b").orderBy(F.col("s").desc())
    assert _sorted(got.collect()) == _sorted(df.withColumn("r", F.dense_rank().over(wk)).where("r = 1").drop("r")
                                             .collect())
