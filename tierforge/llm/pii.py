"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Built-in functions only; a map over rows without a shuffle.

Defined cases: a null text counts as empty (no spans); other columns may be
null or bear any name; repeated rows give repeated results; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.common import let
from tierforge.llm.spans import joined, located, overlaps

# The patterns of the base kinds. Runs are possessive and start
# at a run's first character or at the end of the match before (\G), which
# finds the same matches without trying every suffix of a long run.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
# Added kinds: bank account numbers (mod 97) and identity numbers, which only context confirms.
IBAN = r"(?:\G|(?<![A-Za-z0-9]))[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "identity")

# Score of a confirmed span, and the words nearby that raise it by RAISE.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "identity": 0.4}
CONTEXT = {
    "email": "mail|contact|address",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|konto",
    "identity": "ssn|social security|identity|passport|insurance",
}
RAISE = 0.3
MIN_SCORE = 0.5


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True when a string of digits passes the Luhn check."""
    def doubled(d: Column, i: Column) -> Column:
        n = d.cast("int")
        return F.when(i % 2 == 0, n).otherwise(n * 2 - F.when(n > 4, 9).otherwise(0))

    parts = F.transform(F.split(F.reverse(digits), "(?<=[0-9])(?=[0-9])"), doubled)
    return F.aggregate(parts, F.lit(0), lambda s, x: s + x) % 10 == 0


def mod97(value: Column) -> Column:
    """Remainder by 97 of an account number, its first four characters moved to the end."""
    compact = F.regexp_replace(value, r"\x20", "")
    moved = let(compact, lambda v: F.concat(F.right(v, F.length(v) - 4), F.left(v, F.lit(4))))
    chars = F.split(moved, "(?<=.)(?=.)")
    return F.aggregate(chars, F.lit(0), lambda r, c: F.when(
        c.between("0", "9"), (r * 10 + c.cast("int")) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97))


def _confirmed(kind: str, span: Column) -> Column:
    value = span["text"]
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return mod97(value) == 1
    return F.lit(True)


def _scored(kind: str, span: Column) -> Column:
    near = F.lower(F.concat_ws(" ", span["before"], span["after"])).rlike(CONTEXT[kind])
    score = F.lit(SCORES[kind]) + F.when(near, RAISE).otherwise(0.0)
    return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
                    span["text"].alias("text"), F.least(score, F.lit(1.0)).alias("score"))


def _kind_spans(text: Column, kind: str, pattern: str, needs: str | None) -> Column:
    spans = F.transform(F.filter(located(text, pattern), lambda s: _confirmed(kind, s)), lambda s: _scored(kind, s))
    if needs is None:
        return spans
    return F.when(F.contains(text, F.lit(needs)), spans).otherwise(F.array().cast(SCORED_TYPE))


SCORED_TYPE = "array<struct<kind:string,start:bigint,end:bigint,text:string,score:double>>"


def find_pii(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` plus ``out``: a struct with one array of scored spans per kind (SCORED_TYPE).

    Base kinds keep every confirmed match. Added kinds keep spans that score at
    least MIN_SCORE and overlap no base span.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    base = {
        "email": _kind_spans(value, "email", EMAIL, "@"),
        "ip": _kind_spans(value, "ip", IP, "."),
        "card": _kind_spans(value, "card", CARD, None),
        "phone": _kind_spans(value, "phone", PHONE, "+"),
    }
    added = {
        "iban": _kind_spans(value, "iban", IBAN, None),
        "identity": _kind_spans(value, "identity", IDENTITY, "-"),
    }
    spans = F.struct(*[F.array_compact(c).cast(SCORED_TYPE).alias(k) for k, c in {**base, **added}.items()])

    def settle(s: Column) -> Column:
        known = F.concat(*[s[k] for k in BASE_KINDS])
        more = [F.filter(s[k], lambda x: (x["score"] >= MIN_SCORE) & ~overlaps(x, known)).alias(k) for k in added]
        return F.struct(*[s[k].alias(k) for k in BASE_KINDS], *more)

    return docs.withColumn(out, let(spans, settle))


def pii_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, mean score."""
    found = find_pii(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    every = F.concat(*[F.col("pii")[k] for k in KINDS])
    return found.select(
        "doc_id", *[F.size(F.col("pii")[k]).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(F.concat(*[F.col("pii")[k] for k in BASE_KINDS])), 256).alias("base_sha256"),
        joined(every).alias("spans"),
        F.concat_ws(",", F.transform(every, lambda s: F.format_number(s["score"], 2))).alias("scores"),
    )
