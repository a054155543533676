"""Refresh of the windowed silver builds by touched keys.

The latest record of a customer and the end dates of a product's versions
depend on all rows of a key, but of no other key. The raw rows and the silver
table are kept in buckets by a hash of the key. A feed increment names the keys
it touches; only their rows are rebuilt, and only their buckets are read and
rewritten, the silver table in one atomic step.

The raw rows are extended first. A run that is lost between the two steps is
repaired by the next one: the silver table's label names the raw version it
was built from, and all keys of raw rows behind that version count as touched.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.plans import tables as T
from tierforge.sources import commits

BUCKETS = 256
_BUCKET = "__bucket"


@dataclass(frozen=True)
class KeyedBuild:
    """A silver build whose rows of one key depend on raw rows of that key only."""

    raw_key: str
    silver_key: str               # the column of the built rows that holds the raw key
    build: Callable[[DataFrame], DataFrame]


RAW_KEY = "__raw_key"             # for T2, whose own columns don't give the full key back
BUILDS = {
    "silver_customers": KeyedBuild("cst_id", "cst_id", T.silver_customers),
    "silver_product_versions": KeyedBuild("prd_key", RAW_KEY, lambda raw: T.silver_product_versions(raw, RAW_KEY)),
}


def _bucket(df: DataFrame, column: str, buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(F.col(column)), F.lit(buckets)).cast("int"))


def refresh(spark: SparkSession, root: str, table: str, increment: DataFrame, buckets: int = BUCKETS) -> commits.Version:
    """Add the raw rows of ``increment`` and bring ``table`` up to date; its new version.

    ``<root>/raw`` and ``<root>/table`` belong to this function; ``buckets`` must
    stay the same for one root.
    """
    spec, raw_path, silver_path = BUILDS[table], os.path.join(root, "raw"), os.path.join(root, "table")
    silver = commits.version(spark, silver_path)
    done = commits.version(spark, raw_path, int(silver.label)).parts if silver else ()
    added = commits.replace_buckets(_bucket(increment, spec.raw_key, buckets).repartition(_BUCKET), raw_path, _BUCKET, ())
    # usually the increment alone; after a lost run also what that one had added
    behind = tuple(p for p in added.parts if p not in done)
    touched = commits.read(spark, raw_path, replace(added, parts=behind)).select(spec.raw_key).distinct()
    numbers = sorted({int(p.rpartition("=")[2]) for p in behind})
    raw = commits.read(spark, raw_path, commits.bucket_parts(added, _BUCKET, numbers))
    keys = touched.select(F.col(spec.raw_key).alias("__touched"))
    built = spec.build(raw.join(keys, F.col(spec.raw_key).eqNullSafe(F.col("__touched")), "left_semi"))
    if silver is not None:
        old = commits.read(spark, silver_path, commits.bucket_parts(silver, _BUCKET, numbers))
        kept = old.join(keys, F.col(spec.silver_key).eqNullSafe(F.col("__touched")), "left_anti")
        built = kept.unionByName(built)
    rows = _bucket(built, spec.silver_key, buckets).repartition(_BUCKET)
    return commits.replace_buckets(rows, silver_path, _BUCKET, numbers, silver.number if silver else 0, label=str(added.number))


def current(spark: SparkSession, root: str) -> DataFrame:
    """The silver table as it is now."""
    path = os.path.join(root, "table")
    rows = commits.read(spark, path, commits.version(spark, path))
    return rows.drop(RAW_KEY)
