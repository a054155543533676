"""Property tests: each skew-safe operator equals its plain Spark formulation on random inputs."""

import datetime as d

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierforge.functions.clean import parse_yyyymmdd
from tierforge.operators import end_date_versions, keep_latest, surrogate_key

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 4))
days = st.one_of(st.none(), st.integers(0, 30).map(lambda n: d.date(2020, 1, 1) + d.timedelta(days=n)))
rows = st.lists(st.tuples(keys, days), min_size=1, max_size=60)


def _multiset(df):
    return sorted(tuple("~" if v is None else str(v) for v in r) for r in df.collect())


@SETTINGS
@given(rows)
def test_keep_latest_is_dense_rank_one(spark, data):
    df = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(data)], "k int, s date, i int")
    w = Window.partitionBy("k").orderBy(F.col("s").desc())
    expected = df.withColumn("r", F.dense_rank().over(w)).where("r = 1").drop("r")
    assert _multiset(keep_latest(df, "k", "s")) == _multiset(expected)
    first = keep_latest(df, "k", "s", ties="first", tie_breaker="i")
    w1 = Window.partitionBy("k").orderBy(F.col("s").desc(), F.col("i"))
    assert _multiset(first) == _multiset(df.withColumn("r", F.row_number().over(w1)).where("r = 1").drop("r"))


@SETTINGS
@given(rows, st.integers(1, 9))
def test_end_date_split_is_lead(spark, data, partitions):
    df = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(data)], "k int, s date, i int")
    w = Window.partitionBy("k").orderBy(F.col("s").asc_nulls_first(), "i")
    expected = df.withColumn("e", F.date_sub(F.lead("s").over(w), 1))
    got = end_date_versions(df, "k", "s", ["i"], "e", partitions=partitions)
    assert _multiset(got) == _multiset(expected)


@SETTINGS
@given(rows, st.integers(2, 40))
def test_ranged_keys_are_global_keys(spark, data, per_bucket):
    df = spark.createDataFrame([(k, s, i) for i, (k, s) in enumerate(data)], "k int, s date, i int")
    glob = surrogate_key(df, ["k", "s", "i"], "key", method="global")
    ranged = surrogate_key(df, ["k", "s", "i"], "key", method="ranged", rows_per_bucket=per_bucket)
    assert _multiset(ranged) == _multiset(glob)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-10**9, 10**9), st.integers(10**7, 10**8 - 1)),
                min_size=1, max_size=80))
def test_parse_yyyymmdd_is_try_to_date(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    text = F.col("v").cast("string")
    ref = F.when((F.col("v") > 0) & (F.length(text) == 8), F.try_to_date(text, "yyyyMMdd"))
    out = df.select(ref.alias("a"), parse_yyyymmdd("v").alias("b"))
    assert out.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
