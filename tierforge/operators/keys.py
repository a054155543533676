"""Surrogate keys (W3, W4): ``row_number`` over a global order, without one task.

``Window.orderBy(...)`` with no partition moves every row into a single
partition. The default numbers the rows of an ordered table instead (see
``ranged``): key = rows in the partitions before + place in the own one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.operators.ranged import offsets, ordered_table


def surrogate_key(df: DataFrame, order: str | Sequence[str], name: str, method: str = "ranged",
                  rows_per_bucket: int | None = None) -> DataFrame:
    """Prepend ``name`` = 1..n (bigint) following ``order`` ascending, nulls first.

    ``method``: ``"ranged"``, ``"auto"`` and ``"global"`` give the same keys by the same
    distributed numbering (the last two are the names of older forms).
    ``rows_per_bucket`` asks for so many rows per range partition (this counts
    the rows first); without it adaptive execution sizes the partitions.
    """
    cols = [order] if isinstance(order, str) else list(order)
    if method not in ("auto", "global", "ranged"):
        raise ValueError(f"unknown surrogate key method {method!r}")
    parts = max(1, math.ceil(df.count() / rows_per_bucket)) if rows_per_bucket is not None else None
    table = ordered_table(df, cols, parts)
    return table.join(F.broadcast(offsets(table)), "__p").select(
        (F.col("__base") + F.col("__pos") + 1).alias(name), *df.columns)
