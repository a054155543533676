"""Record-version operators: latest per key (W1), end-dating (W2), current rows.

Both window-style operators are written so that a key holding a large share
of all rows never has to be sorted by a single task:

* ``keep_latest`` pre-aggregates ``max(order)`` per key (map-side partial
  aggregation) and joins it back on ``(key, order)``: the join hashes on the
  order value too, and AQE splits whatever skew remains.
* ``end_date_versions`` orders all rows by (key, start) over range partitions
  and looks at the next row, across partition borders too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.operators.ranged import next_rows, ordered_table


def _as_list(v: str | Sequence[str]) -> list[str]:
    return [v] if isinstance(v, str) else list(v)


def _keep_extreme(df: DataFrame, keys: list[str], column: str, agg) -> DataFrame:
    """Rows whose ``column`` equals ``agg(column)`` within their key group.

    Null keys form one group and an all-null column keeps all rows, exactly as
    ``dense_rank() == 1`` over a window would.
    """
    best = df.groupBy(*keys).agg(agg(column).alias("__best"))
    best = best.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__best")
    cond = F.col(column).eqNullSafe(F.col("__best"))
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return df.join(best, cond, "inner").select(*df.columns)


def keep_latest(df: DataFrame, keys: str | Sequence[str], order: str, ties: str = "keep",
                tie_breaker: str | None = None) -> DataFrame:
    """W1 + F2: keep the rows with the greatest ``order`` value per key.

    Same result as ``dense_rank().over(partitionBy(keys).orderBy(desc(order))) == 1``:
    nulls sort last, so a group whose order values are all null keeps all rows.
    ``ties="keep"`` (default, source parity) keeps every tied row;
    ``ties="first"`` then keeps exactly one row per key, the one with the
    smallest ``tie_breaker`` (nulls last), like ``row_number() == 1``.
    """
    keys = _as_list(keys)
    if ties not in ("keep", "first") or (ties == "first" and tie_breaker is None):
        raise ValueError("ties must be 'keep', or 'first' together with a tie_breaker column")
    out = _keep_extreme(df, keys, order, F.max)
    if ties == "keep":
        return out
    # One partial aggregation over the tied rows: the whole row of the
    # smallest (tie_breaker is null, tie_breaker) per key.
    rank = F.struct(F.col(tie_breaker).isNull(), F.col(tie_breaker))
    picked = out.groupBy(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)]).agg(
        F.min_by(F.struct(*[F.col(c) for c in df.columns]), rank).alias("__row"))
    return picked.select("__row.*")


def end_date_versions(df: DataFrame, key: str | Sequence[str], start: str,
                      tie_breaker: Sequence[str] = (), name: str = "end_date",
                      partitions: int | None = None) -> DataFrame:
    """W2 + X11: ``name`` = next version's ``start`` (per ``key``) minus one day.

    Versions are ordered by ``start`` (nulls first) then ``tie_breaker``; the
    last version of a key gets null. ``start`` must be a date or timestamp; the
    result is a date. Rows are ordered by (key, start, tie-breakers) over all
    tasks, so a key of any size is split by its starts and tie-breakers.
    ``partitions`` forces a number of range partitions (tests).
    """
    keys = _as_list(key)
    table = ordered_table(df, [*keys, start, *tie_breaker], partitions)
    value = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(start).alias("v"))
    followed = next_rows(table, value, "__next")
    same = F.col("__next").isNotNull()
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__next.k{i}"))
    return followed.select(*df.columns, F.when(same, F.date_sub(F.col("__next.v"), 1)).alias(name))


def current_only(df: DataFrame, end_col: str) -> DataFrame:
    """Rows whose end date is null (the current version)."""
    return df.where(F.col(end_col).isNull())
