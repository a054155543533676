"""Pattern matches with their code-point offsets, by built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierforge.llm.common import let, prefix_sums

SPAN_TYPE = "array<struct<start:bigint,end:bigint,text:string,before:string,after:string>>"


def located(text: Column, pattern: str, context: int = 40) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` in order, as SPAN_TYPE.

    Splitting at the pattern gives the text between matches; lengths of gaps
    and matches add up to the offsets (code points, end exclusive). ``before``
    and ``after`` hold up to ``context`` characters of the neighbouring gaps.
    The pattern must not match the empty string.
    """
    def place(matches: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            steps = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches,
                               lambda g, m: (F.length(g) + F.length(m)).cast("bigint"))
            rows = F.arrays_zip(prefix_sums(steps).alias("e"), matches.alias("m"),
                                F.slice(gaps, 1, F.size(matches)).alias("b"),
                                F.slice(gaps, 2, F.size(matches)).alias("a"))
            return F.transform(rows, lambda r: F.struct(
                (r["e"] - F.length(r["m"])).alias("start"), r["e"].alias("end"), r["m"].alias("text"),
                F.right(r["b"], F.lit(context)).alias("before"), F.left(r["a"], F.lit(context)).alias("after")))

        return F.when(F.size(matches) > 0, let(F.split(text, pattern, -1), with_gaps))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)
    return F.coalesce(found.cast(SPAN_TYPE), F.array().cast(SPAN_TYPE))


def overlaps(span: Column, others: Column) -> Column:
    """True when ``span`` shares a character with one of ``others``."""
    return F.exists(others, lambda o: (span["start"] < o["end"]) & (o["start"] < span["end"]))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined in array order."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
