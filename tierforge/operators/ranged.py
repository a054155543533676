"""Rows in one global order over many tasks, as a written table.

The one primitive behind surrogate keys and end-dating: range-partition the
rows on the order columns (sampled bounds), sort inside each partition, and
tag every row with its partition and its place there. The tagged rows are
written to the session's shared checkpoint folder, so a retry can't move a
row to another place. A hot value of a leading column is split by the columns
behind it; only rows that tie on every order column share a partition.

What reaches the driver or a single task is one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierforge.session import scratch_path

# monotonically_increasing_id puts the partition index above bit 33.
_PARTITION_SHIFT = 33


def ordering(cols: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in cols]


def ordered_table(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` plus ``__p`` (range partition) and ``__pos`` (0-based place inside it).

    Without ``partitions`` the exchange uses the session's shuffle width and
    adaptive execution sizes the partitions. The input is written first,
    because range partitioning reads it twice (bounds, then rows).
    """
    spark = df.sparkSession
    source_path, path = scratch_path(spark, "unordered"), scratch_path(spark, "ordered")
    df.write.parquet(source_path)
    source = spark.read.schema(df.schema).parquet(source_path)
    pid = F.spark_partition_id()
    keys = ordering(cols)
    ranged = source.repartitionByRange(partitions, *keys) if partitions else source.repartitionByRange(*keys)
    tagged = ranged.sortWithinPartitions(*keys).select(
        "*", pid.alias("__p"),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), _PARTITION_SHIFT)).alias("__pos"))
    tagged.write.parquet(path)
    return spark.read.schema(tagged.schema).parquet(path)


def offsets(table: DataFrame) -> DataFrame:
    """``(__p, __base)``: rows before each partition of an ordered table; one row per partition."""
    counts = sorted(table.groupBy("__p").count().collect())
    rows, before = [], 0
    for p, n in counts:
        rows.append((p, before))
        before += n
    return table.sparkSession.createDataFrame(rows, "__p int, __base bigint")


def next_rows(table: DataFrame, value: Column, name: str) -> DataFrame:
    """``table`` plus ``name``: ``value`` (a struct) of the row that follows in the whole order, null at the end.

    Inside a partition that is a window over its places; the last row of a
    partition looks at the first row of the next one that has rows.
    """
    inside = table.withColumn("__lead", F.lead(value).over(Window.partitionBy("__p").orderBy("__pos")))
    firsts = table.where("__pos = 0").select(F.col("__p").alias("__q"), value.alias("__first"))
    # one row per partition: bounded by the shuffle width, not by the data
    follow = firsts.select("__q", F.lead("__first").over(Window.orderBy("__q")).alias("__follow"))
    joined = inside.join(F.broadcast(follow), F.col("__p") == F.col("__q"), "left")
    return joined.select(*table.columns, F.coalesce("__lead", "__follow").alias(name))
