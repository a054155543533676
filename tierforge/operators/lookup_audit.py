"""Key audit of dimension lookups (J1-J5): what matched, what missed, what was multiplied.

The counts are taken on the joined rows, in the pass that writes them, so the
left side is read once. An unmatched left row leaves one row; a matched one
leaves as many as the right side has rows of its key, of which one is marked.
From the marks follow the left rows again:

    left rows = missed + matched, fan-out = joined rows - left rows

Rows of one key on the right are found in two steps. A mergeable sketch counts
the keys' hashes in a fixed number of cells, which can't miss a repeated key;
only the rows of cells that were met twice are grouped by the key itself.

Where both sides repeat their keys, the joined rows grow with the product of
the repeats. Such a lookup can be kept folded (``multiply=False``): every left
row once, with the number of its matches, and beside them the right rows by
key (``matches``). ``unfolded`` multiplies them. The counts are the same.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tierforge.operators.star import KeyPairs, lookup

CELLS = 1 << 20            # of the sketch: at most so many rows of 16 bytes
_FIRST = "__first"
N_MATCHES = "n_matches"    # of a folded lookup: right rows of the left row's key, null if there are none


@dataclass
class LookupAudit:
    """Counts of one lookup; to be read after the action that ran it."""

    name: str
    seen: Observation

    def counts(self) -> dict[str, int]:
        n = {k: int(v or 0) for k, v in self.seen.get.items()}
        left = n["missed"] + n["matched"]
        return {"left_rows": left, "matched": n["matched"], "missed": n["missed"], "null_keys": n["null_keys"],
                "fan_out": n["joined"] - left}


def _keyed(df: DataFrame, columns: list[str], normalize: Callable[[Column], Column] | None) -> tuple[DataFrame, list[str]]:
    norm = normalize or (lambda c: c)
    names = [f"__q{i}" for i in range(len(columns))]
    return df.select("*", *[norm(F.col(c)).alias(n) for c, n in zip(columns, names)]), names


def repeated_keys(df: DataFrame, columns: list[str], normalize: Callable[[Column], Column] | None = None,
                  cells: int = CELLS) -> DataFrame:
    """``__q0, __q1, ..., n``: keys (after ``normalize``) of more than one row; null keys match nothing and are left out."""
    keyed, names = _keyed(df, columns, normalize)
    keyed = keyed.select(*names).dropna()
    cell = F.pmod(F.xxhash64(*names), F.lit(cells)).alias("__cell")
    met_twice = keyed.select(cell).groupBy("__cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__cell")
    suspects = keyed.select("*", cell).join(met_twice, "__cell", "left_semi")
    return suspects.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _pairs(on: KeyPairs) -> list[tuple[str, str]]:
    return [on] if isinstance(on, tuple) and isinstance(on[0], str) else list(on)


def _empty_key(pairs: list[tuple[str, str]]) -> Column:
    out = F.lit(False)
    for lk, _ in pairs:
        out = out | F.col(lk).isNull()
    return out


def matches(right: DataFrame, on: KeyPairs, take: Mapping[str, str],
            normalize: Callable[[Column], Column] | None = None) -> DataFrame:
    """``__q0, __q1, ...`` (keys after ``normalize``) and the taken columns of the right rows that can match."""
    keyed, names = _keyed(right, [r for _, r in _pairs(on)], normalize)
    return keyed.select(*names, *[F.col(c).alias(out) for c, out in take.items()]).dropna(subset=names)


def _folded(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], normalize: Callable[[Column], Column] | None) -> DataFrame:
    """``left``, every row once, and ``N_MATCHES``."""
    keyed, names = _keyed(right, [r for _, r in pairs], normalize)
    n_rows = keyed.select(*names).dropna().groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    norm = normalize or (lambda c: c)
    mine = [f"__l{i}" for i in range(len(pairs))]
    rows = left.select("*", *[norm(F.col(lk)).alias(n) for (lk, _), n in zip(pairs, mine)])
    # a derived key beside them asks for an exchange after the grouping, so that hot left keys can be split
    rows, n_rows = rows.withColumn("__lj", F.xxhash64(*mine)), n_rows.withColumn("__qj", F.xxhash64(*names))
    return lookup(rows, n_rows, [*zip(mine, names), ("__lj", "__qj")], {"__n": N_MATCHES}).drop(*mine, "__lj")


def unfolded(folded: DataFrame, found: DataFrame, on: KeyPairs, take: Mapping[str, str],
             normalize: Callable[[Column], Column] | None = None) -> DataFrame:
    """The rows of ``lookup(left, right, on, take, normalize=...)`` from a folded lookup and its ``matches``."""
    pairs, norm = _pairs(on), normalize or (lambda c: c)
    mine = [f"__l{i}" for i in range(len(pairs))]
    rows = folded.drop(N_MATCHES).select("*", *[norm(F.col(lk)).alias(n) for (lk, _), n in zip(pairs, mine)])
    keys = [(n, f"__q{i}") for i, n in enumerate(mine)]
    return lookup(rows, found, keys, {out: out for out in take.values()}).drop(*mine)


def audited_lookup(left: DataFrame, right: DataFrame, on: KeyPairs, take: Mapping[str, str], name: str = "lookup",
                   normalize: Callable[[Column], Column] | None = None, multiply: bool = True) -> tuple[DataFrame, LookupAudit]:
    """``lookup(left, right, on, take, normalize=...)`` and its audit.

    Without ``multiply`` the lookup stays folded: every left row once and ``N_MATCHES``, not the taken columns.
    """
    pairs = _pairs(on)
    seen = Observation(f"lookup_{uuid.uuid4().hex[:8]}")
    n_null = F.count_if(_empty_key(pairs)).alias("null_keys")
    if not multiply:
        n = F.col(N_MATCHES)
        counted = _folded(left, right, pairs, normalize).observe(
            seen, F.sum(F.coalesce(n, F.lit(1))).alias("joined"), F.count_if(n.isNull()).alias("missed"),
            F.count_if(n.isNotNull()).alias("matched"), n_null)
        return counted, LookupAudit(name, seen)
    keys = [r for _, r in pairs]
    keyed, names = _keyed(right, keys, normalize)
    twice = repeated_keys(right, keys, normalize)
    # rows of keys that occur once are first by themselves; the others are numbered
    once = keyed.join(twice, names, "left_anti").withColumn(_FIRST, F.lit(True))
    more = keyed.join(twice, names, "left_semi")
    place = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    marked = once.unionByName(more.withColumn(_FIRST, place == 1)).drop(*names)
    joined = lookup(left, marked, on, {**take, _FIRST: _FIRST}, normalize=normalize)
    counted = joined.observe(seen, F.count(F.lit(1)).alias("joined"), F.count_if(F.col(_FIRST).isNull()).alias("missed"),
                             F.count_if(F.col(_FIRST)).alias("matched"), n_null)
    return counted.drop(_FIRST), LookupAudit(name, seen)
