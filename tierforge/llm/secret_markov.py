"""Secrets: fixed patterns, plus tokens that look random to two character Markov models.

Built-in functions only. A first-order Markov model of random strings and one
of ordinary identifiers are counted from a labelled sample of the corpus; a
token is a finding when the log-likelihood ratio per character is high.

Defined cases: a null text counts as empty (no spans); other columns may be
null or bear any name; a corpus without any sample gives a model that adds no
spans; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.common import let, sampled, written
from tierforge.llm.spans import joined, located, overlaps

# The patterns of the base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?:\G|(?<![0-9a-f]))[0-9a-f]{24,}+"
# What the model looks at, and what the ordinary sample is drawn from.
CANDIDATE = r"(?:\G|(?<![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]{20,}+"
ORDINARY = r"[A-Za-z_]{6,64}"

BASE_KINDS = ("assign", "access", "hex")
MODEL_KIND = "markov"
MIN_VALUE = 6
# The labelled sample: at most SAMPLE_DOCS documents, SAMPLE_TOKENS tokens of each.
SAMPLE_DOCS, SAMPLE_TOKENS = 4000, 32
SYMBOLS = 128          # ASCII; other characters end a token
MIN_RATIO = 0.8        # mean log-likelihood ratio (natural log) per character
SPAN_TYPE = "array<struct<start:bigint,rank:int,end:bigint,kind:string,text:string,score:double>>"


def _typed(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
        s["text"].alias("text"), F.lit(None).cast("double").alias("score"))).cast(SPAN_TYPE)


def base_spans(text: Column) -> Column:
    """Spans of the base kinds as SPAN_TYPE, by start, then kind."""
    assign = F.filter(located(text, ASSIGN, 0),
                      lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 1)) >= MIN_VALUE)
    access = F.when(F.contains(text, F.lit("AKIA")), _typed(located(text, ACCESS, 0), "access", 1))
    return F.array_sort(F.concat(_typed(assign, "assign", 0),
                                 F.coalesce(access, F.array().cast(SPAN_TYPE)),
                                 _typed(located(text, HEX, 0), "hex", 2)))


def _bigrams(tokens: DataFrame) -> DataFrame:
    codes = F.transform(F.split("token", "(?<=.)(?=.)"), lambda c: F.ascii(c))
    pairs = let(codes, lambda a: F.zip_with(F.slice(a, 1, F.size(a) - 1), F.slice(a, 2, F.size(a)),
                                            lambda x, y: x * SYMBOLS + y))
    return tokens.where(F.length("token") > 1).select("label", F.explode(pairs).alias("pair"))


def fit_ratio(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS,
              sample_tokens: int = SAMPLE_TOKENS) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of every pair of ASCII characters.

    Labelled sample: base findings and the letters of digests of sampled words
    are random, words are ordinary. The sample is bounded by its parameters;
    the result has SYMBOLS squared numbers whatever the corpus.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    texts = sampled(docs.select(F.xxhash64(value).alias("key"), value.alias("text")), "key", sample_docs)
    words = F.slice(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0)), 1, sample_tokens)
    found = F.slice(F.transform(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1)), lambda v: v), 1, sample_tokens)
    # written: three branches below read it
    sample = written(texts.select(words.alias("words"), found.alias("found")), "secret-sample")
    ordinary = sample.select(F.lit(0).alias("label"), F.explode("words").alias("token"))
    digest = F.base64(F.unhex(F.sha2(F.col("token"), 256)))
    random = ordinary.select(F.lit(1).alias("label"), digest.alias("token")).unionByName(
        sample.select(F.lit(1).alias("label"), F.explode("found").alias("token")))
    counts = _bigrams(ordinary.unionByName(random)).groupBy("label", "pair").agg(F.count(F.lit(1)).alias("n"))
    seen: tuple[dict[int, int], dict[int, int]] = ({}, {})
    for r in counts.collect():                       # at most 2 * SYMBOLS ** 2 rows
        seen[r["label"]][r["pair"]] = r["n"]
    if not seen[0] or not seen[1]:
        return [0.0] * (SYMBOLS * SYMBOLS)
    rows = [[0] * SYMBOLS for _ in seen]
    for label, table in enumerate(seen):
        for pair, n in table.items():
            rows[label][pair // SYMBOLS] += n
    alphabet = 66                                    # letters, digits and four signs
    return [math.log((seen[1].get(p, 0) + 0.5) / (rows[1][p // SYMBOLS] + 0.5 * alphabet))
            - math.log((seen[0].get(p, 0) + 0.5) / (rows[0][p // SYMBOLS] + 0.5 * alphabet))
            for p in range(SYMBOLS * SYMBOLS)]


def mean_ratio(token: Column, ratio: Column) -> Column:
    """Mean log-likelihood ratio of a token's character pairs."""
    codes = F.transform(F.split(token, "(?<=.)(?=.)"), lambda c: F.ascii(c))
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    total = F.aggregate(codes, start, lambda acc, c: F.struct(
        c.alias("last"),
        F.when(acc["last"] < 0, acc["sum"])
         .otherwise(acc["sum"] + F.element_at(ratio, acc["last"] * SYMBOLS + c + 1)).alias("sum")),
        lambda acc: acc["sum"])
    return total / F.greatest(F.length(token) - 1, F.lit(1))


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets", ratio: list[float] | None = None,
                 min_ratio: float = MIN_RATIO) -> DataFrame:
    """``docs`` plus ``out``: SPAN_TYPE of base findings and of tokens the models call random.

    A token needs letters and digits and a mean ratio of at least
    ``min_ratio``; it is left out where it overlaps a base finding.
    """
    table = fit_ratio(docs, text) if ratio is None else ratio
    literal = F.split(F.lit(",".join(repr(x) for x in table)), ",").cast("array<double>")
    value = F.coalesce(F.col(text), F.lit(""))
    candidates = F.filter(located(value, CANDIDATE, 0),
                          lambda s: s["text"].rlike("[0-9]") & s["text"].rlike("[A-Za-z]"))

    def settle(base: Column) -> Column:
        scored = F.transform(candidates, lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(BASE_KINDS)).alias("rank"), s["end"].alias("end"),
            F.lit(MODEL_KIND).alias("kind"), s["text"].alias("text"), mean_ratio(s["text"], literal).alias("score")))
        kept = F.filter(scored, lambda s: (s["score"] >= min_ratio) & ~overlaps(s, base))
        return F.array_sort(F.concat(base, kept.cast(SPAN_TYPE)))

    return docs.withColumn(out, let(base_spans(value), settle))


def _is(kind: str):
    return lambda s: s["kind"] == kind


def secret_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts and digest of the base findings, all findings."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = find_secrets(rows)
    base = F.filter("secrets", lambda s: s["kind"] != MODEL_KIND)
    return found.select(
        "doc_id",
        *[F.size(F.filter("secrets", _is(k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
