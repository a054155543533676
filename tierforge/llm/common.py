"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import math
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierforge.session import scratch_path

# Fixed value: the white space that the operators fold or split on.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per context.

    The driver serves the archive, so executors need no shared code folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tierforge_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="tierforge-code-"), "tierforge.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._tierforge_shipped = True


def release() -> None:
    """Give back to the system what this Python worker no longer uses (workers outlive their tasks)."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc only
    if trim is not None:
        trim(0)


def frugal(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A mapInArrow function that releases its memory when the task ends."""
    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            release()

    return run


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (bound as a lambda variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(lengths: Column, block: int = 256) -> Column:
    """Running sums of an array<bigint>, in blocks so that long arrays stay near linear."""
    def in_block(part: Column, base: Column) -> Column:
        start = F.struct(base.alias("s"), F.array().cast("array<bigint>").alias("a"))
        return F.aggregate(
            part, start,
            lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"] + x)).alias("a")),
            lambda acc: acc["a"])

    def over(a: Column) -> Column:
        count = F.ceil(F.size(a) / F.lit(block)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(a, b * block + 1, block))
        zero = F.lit(0).cast("bigint")

        def place(ps: Column) -> Column:
            sums = F.transform(ps, lambda p: F.aggregate(p, zero, lambda s, x: s + x))
            bases = F.aggregate(sums, F.array(zero), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s)))
            return F.flatten(F.zip_with(ps, F.slice(bases, 1, F.size(ps)), in_block))

        return F.when(F.size(a) > 0, let(parts, place)).otherwise(F.array().cast("array<bigint>"))

    return let(lengths.cast("array<bigint>"), over)


def fingerprint(*cols: Column | str) -> list[Column]:
    """Two independent 64-bit hashes of ``cols`` (nulls count as a value of their own)."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    # a hash skips nulls, so their places are hashed as well
    nulls = F.concat(*[F.when(p.isNull(), F.lit("1")).otherwise(F.lit("0")) for p in parts])
    return [F.xxhash64(F.lit(salt), nulls, *parts) for salt in ("first", "second")]


def keyed(docs: DataFrame, *cols: str) -> DataFrame:
    """``docs`` with ``__k1, __k2``: the row's identity, a 128-bit hash of ``cols``."""
    k1, k2 = fingerprint(*cols)
    return docs.withColumns({"__k1": k1, "__k2": k2})


def spread_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on non-null ``keys`` whose hot partitions adaptive execution can split.

    An aggregate of ``right`` by ``keys`` already fixes its partitioning, and a
    skewed join over it can't be dealt anew. Joining on a derived key as well
    asks for an exchange on both sides, which adaptive execution may split.
    """
    derived = F.xxhash64(F.lit("join"), *[F.col(k) for k in keys]).alias("__jk")
    return left.select("*", derived).join(right.select("*", derived), ["__jk", *keys], how).drop("__jk")


def total_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of a text column, summed by Spark (one number reaches the driver)."""
    return docs.select(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def parts_for(docs: DataFrame, column: str = "text", bytes_per_part: int = 32 << 20) -> int:
    """How many hash parts keep each part's share of the text near ``bytes_per_part``."""
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(width, math.ceil(total_bytes(docs, column) / bytes_per_part))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder (cuts the lineage)."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(table: DataFrame, max_rows: int) -> DataFrame:
    """Mark a *written* table of fixed-width rows for broadcast if it has at most ``max_rows`` rows.

    The count reads Parquet footers only. A larger table is left to the
    optimizer, which joins it by a shuffle.
    """
    return F.broadcast(table) if table.count() <= max_rows else table


def without(docs: DataFrame, decisions: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """``docs`` without the rows that ``decisions`` (``__k1, __k2, kept``) does not keep; columns unchanged.

    ``docs`` must be keyed() over doc_id and text. The dropped keys take 16
    bytes each; more than ``max_rows`` of them are joined by a shuffle.
    """
    dropped = written(decisions.where(~F.col("kept")).select("__k1", "__k2").distinct(), "dropped")
    columns = [c for c in docs.columns if c not in ("__k1", "__k2")]
    return docs.join(bounded_broadcast(dropped, max_rows), ["__k1", "__k2"], "left_anti").select(*columns)


def sampled(rows: DataFrame, key: str, size: int, by: str | None = None) -> DataFrame:
    """One row of each of the ``size`` least hashes of ``key``; with ``by``, so many in each of its values.

    Copies (rows of one ``key``) take one place, and shares count distinct hashes.
    Hashes are thinned to some times ``size`` in a group before they are ranked,
    so what meets in one task does not grow with the input, and the rows
    themselves move only once chosen. One row per value of ``by`` is broadcast.
    """
    group = F.lit(0).cast("bigint") if by is None else F.xxhash64(F.lit("group"), F.col(by))
    hashed = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), F.col(key)), 1)
    rows = rows.withColumns({"__g": group, "__h": hashed})
    bound = F.least(F.lit(1.0), F.lit(8.0 * size) / F.approx_count_distinct("__h")) * F.lit(2.0 ** 63)
    bounds = rows.groupBy("__g").agg(bound.alias("__bound"))
    thin = rows.select("__g", "__h").join(F.broadcast(bounds), "__g").where("__h <= __bound").select("__g", "__h").distinct()
    place = F.row_number().over(Window.partitionBy("__g").orderBy("__h"))
    last = thin.withColumn("__n", place).where(F.col("__n") <= size).groupBy("__g").agg(F.max("__h").alias("__last"))
    chosen = rows.join(F.broadcast(last), "__g").where("__h <= __last")
    return chosen.dropDuplicates(["__g", "__h"]).drop("__g", "__h", "__last")
