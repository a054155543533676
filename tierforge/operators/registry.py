"""Surrogate keys that survive reruns (W3, W4): a registry of the members that have one.

The default keys number a dimension anew on every refresh. With a registry,
known members keep their keys and new ones get the numbers behind the last
key, in the given order, without gaps. The registry is a table with versions;
it is extended in one atomic step from the version that was read, so of two
runs at a time one starts over and no number is given twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.operators.keys import surrogate_key
from tierforge.sources import commits


def _same(key: Sequence[str], known: Sequence[str]) -> Column:
    out = F.lit(True)
    for k, r in zip(key, known):
        out = out & F.col(k).eqNullSafe(F.col(r))
    return out


def _known(registry: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    return registry.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(key)], name)


def register(members: DataFrame, key: Sequence[str], name: str, path: str) -> DataFrame:
    """Give the members (distinct values of ``key``, nulls are values) that ``path`` lacks their keys.

    New keys follow ``key`` ascending, nulls first. Returns the registry: ``key``
    columns and ``name`` (bigint). Rows move only as far as they are new.
    """
    spark, key = members.sparkSession, list(key)
    names = [f"__r{i}" for i in range(len(key))]
    while True:
        newest = commits.version(spark, path)
        fresh, last = members.select(*key).distinct(), 0
        if newest is not None:
            registry = commits.read(spark, path, newest)
            fresh = fresh.join(_known(registry, key, name), _same(key, names), "left_anti")
            last = registry.agg(F.max(name)).first()[0] or 0
        numbered = surrogate_key(fresh, key, name).select(*key, (F.col(name) + last).alias(name))
        try:
            made = commits.append(numbered, path, expected=newest.number if newest else 0)
        except commits.CommitConflict:
            continue                      # another run registered members meanwhile
        return commits.read(spark, path, made)


def registered_key(df: DataFrame, key: str | Sequence[str], name: str, path: str) -> DataFrame:
    """Prepend ``name``: the registered key of each row's member. Rows of one member share it."""
    key = [key] if isinstance(key, str) else list(key)
    registry = register(df, key, name, path)
    names = [f"__r{i}" for i in range(len(key))]
    return df.join(_known(registry, key, name), _same(key, names)).select(name, *df.columns)
