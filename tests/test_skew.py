"""A key holding a third of all rows: results stay whole and no task gets the whole group."""

import contextlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from tierforge.operators import keep_latest, lookup

SCALE_CONF = {  # what a cluster sees: dimensions too big to broadcast, small skew thresholds
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
N = 300_000


@contextlib.contextmanager
def scale_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot(col):
    return F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50_000).alias(col)


def test_lookup_hot_key_is_split(spark):
    with scale_conf(spark):
        facts = spark.range(0, N).select(_hot("cust"), F.col("id").alias("line"))
        dim = spark.range(0, 50_000).select(F.col("id").alias("cid"), (F.col("id") * 10).alias("ckey"))
        joined = lookup(facts, dim, ("cust", "cid"), {"ckey": "customer_key"})
        total = joined.agg(F.count(F.lit(1)).alias("n"), F.sum("customer_key").alias("s")).first()
        assert total.n == N
        assert total.s == facts.select(F.sum(F.col("cust") * 10)).first()[0]
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan


def test_keep_latest_hot_key_spreads_over_order_values(spark):
    with scale_conf(spark):
        versions = spark.range(0, N).select(
            _hot("k"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 400).cast("int")).alias("dt"), "id")
        got = keep_latest(versions, "k", "dt")
        w = Window.partitionBy("k").orderBy(F.col("dt").desc())
        expected = versions.withColumn("r", F.dense_rank().over(w)).where("r = 1").drop("r")
        assert got.count() == expected.count()
        assert got.exceptAll(expected).count() == 0
        # the hot key's rows are hashed together with their date: no join partition holds the group
        sizes = (versions.repartition(16, "dt", "k").groupBy(F.spark_partition_id().alias("p")).count()
                         .agg(F.max("count")).first()[0])
        assert sizes < N / 3


def test_ranged_keys_split_a_hot_leading_value(spark):
    from tierforge.operators import surrogate_key

    df = spark.range(0, N).select(_hot("customer_id"), F.col("id").cast("string").alias("last_name"))
    keyed = surrogate_key(df, ["customer_id", "last_name"], "key", rows_per_bucket=N // 16)
    per_file = keyed.groupBy(F.input_file_name().alias("f")).count()
    hot_files = (keyed.where(F.col("customer_id") == 0).select(F.input_file_name().alias("f"))
                      .distinct().count())
    assert hot_files > 1                                   # the hot value spans several partitions
    assert per_file.agg(F.max("count")).first()[0] < N / 3  # and no partition holds its whole group
    stats = keyed.agg(F.min("key"), F.max("key"), F.countDistinct("key")).first()
    assert tuple(stats) == (1, N, N)


def test_end_dating_splits_a_hot_key_of_null_starts(spark):
    from tierforge.operators import end_date_versions, ordered_table

    with scale_conf(spark):
        df = spark.range(0, N).select(
            _hot("k"), F.when(F.col("id") % 3 != 0, F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")))
                        .alias("s"), "id")
        table = ordered_table(df, ["k", "s", "id"], 16)
        sizes = [r["count"] for r in table.where("k = 0").groupBy("__p").count().collect()]
        assert sum(sizes) >= N / 3 and len(sizes) > 3 and max(sizes) < N / 6
        dated = end_date_versions(df, "k", "s", ["id"], "e", partitions=16)
        w = Window.partitionBy("k").orderBy(F.col("s").asc_nulls_first(), "id")
        expected = df.withColumn("e", F.date_sub(F.lead("s").over(w), 1))
        assert dated.exceptAll(expected).count() == 0 and dated.count() == N


def test_chained_lookups_on_a_hot_key_are_both_split(spark):
    with scale_conf(spark):
        facts = spark.range(0, N).select(_hot("cust"), F.col("id").alias("line"))
        one = spark.range(0, 50_000).select(F.col("id").alias("cid"), (F.col("id") * 10).alias("a"))
        two = spark.range(0, 50_000).select(F.col("id").alias("cid"), (F.col("id") * 7).alias("b"))
        joined = lookup(lookup(facts, one, ("cust", "cid"), {"a": "a"}), two, ("cust", "cid"), {"b": "b"})
        assert len(joined.collect()) == N
        assert joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("(skew=true)") == 2
