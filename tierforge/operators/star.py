"""Dimension lookups for star schemas.

A lookup is a left equi-join that projects a few attributes of the right
side. Semantics follow the source: null keys never match, an unmatched left
row keeps null attributes, and a duplicated right key multiplies left rows.

Strategy: left to Catalyst + AQE (sort-merge, or broadcast once the right
side's measured size is small; skewed left partitions are split by AQE's
skew-join handling, also in chained lookups on one key, for which the session
profiles set ``spark.sql.adaptive.forceOptimizeSkewedJoin``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeyPairs = tuple[str, str] | Sequence[tuple[str, str]]


def lookup(left: DataFrame, right: DataFrame, on: KeyPairs, take: Mapping[str, str],
           how: str = "left", normalize: Callable[[Column], Column] | None = None) -> DataFrame:
    """``left`` joined to ``right`` on ``on`` = (left_col, right_col) pair(s).

    ``take`` maps right-side columns to their output names. ``normalize``
    (e.g. ``F.trim``) is applied to both sides' keys; the normalised key is
    computed once per row, before the exchange.
    """
    pairs = [on] if isinstance(on, tuple) and isinstance(on[0], str) else list(on)
    clash = sorted(set(take.values()) & set(left.columns))
    if clash:
        raise ValueError(f"lookup output names already exist on the left side: {clash}")
    norm = normalize or (lambda c: c)
    lkeys = [f"__lk{i}" for i in range(len(pairs))]
    rkeys = [f"__rk{i}" for i in range(len(pairs))]
    lhs = left.select("*", *[norm(F.col(lc)).alias(k) for (lc, _), k in zip(pairs, lkeys)]) if normalize else left
    rhs = right.select(*[norm(F.col(rc)).alias(k) for (_, rc), k in zip(pairs, rkeys)],
                       *[F.col(c).alias(out) for c, out in take.items()])
    left_names = lkeys if normalize else [lc for lc, _ in pairs]
    cond = None
    for lk, rk in zip(left_names, rkeys):
        c = F.col(lk) == F.col(rk)
        cond = c if cond is None else cond & c
    return lhs.join(rhs, cond, how).drop(*rkeys, *(lkeys if normalize else []))
