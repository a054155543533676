"""Language identification by fusing evidence with Bayes' rule.

Evidence: the likelihood of the text under a character model of each language
(tempered, since neighbouring n-grams aren't independent), the language that
the markup or the record declares, and a prior for the host. Host priors are
smoothed in levels (host, address suffix, whole corpus); host, suffix and
declaration tables are grouped sums of the text posteriors over all documents.

The character model is fitted on a bounded sample of every label's documents
(SAMPLE_DOCS documents of each label, SAMPLE_CHARS characters of each document),
so a rare label is a language as well; everything else is counted over all rows
and whole texts. The model takes 128 KB a label.

A document is rejected (``kept`` false) if it has no letters, or if the models
explain its text but the fused posterior is below MIN_POSTERIOR. A text that is
less likely under every language than under a uniform model is covered by none:
its language is unknown (null, posterior 0), it gives no evidence of its host or
declaration, and it is kept.

Defined cases: null text, host, address or declaration give no evidence of
that kind; a null or letterless text is rejected with a null language; ties go
to the language that sorts first; repeated rows give repeated results; without
any labelled row every language is unknown, and texts with letters are kept if
``keep_unlabelled`` says so, else rejected; other columns may bear any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.common import frugal, keyed, let, sampled, ship, spread_join, written
from tierforge.llm.tokens import slices

SAMPLE_DOCS, SAMPLE_CHARS = 4000, 4000      # documents of each label, characters of each
BUCKETS = 1 << 15         # of hashed character trigrams
TEMPER = 60               # a text counts as at most so many independent trigrams
SMOOTHING = 20.0          # weight of the level above, in documents
DECLARED_SMOOTHING = 5.0
MIN_POSTERIOR = 0.5
SLICE_BYTES = 1 << 18     # text whose trigrams a worker holds at once, some 60 bytes a character
LETTER = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"      # the middle of a trigram that counts


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed character trigrams of all texts, each one's text number, and the count per text.

    Lower case; ASCII signs and white space all count as a space. A trigram
    counts if its middle is not a space.
    """
    lowered = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    codes = np.where((codes < 128) & ~((codes >= 97) & (codes <= 122)), 32, codes).astype(np.uint64)
    h = (codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1]) * np.uint64(0x85EBCA77) + codes[2:]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    bucket = (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])[1:-1]
    good = codes[1:-1] != 32
    return bucket[good], owner[good], np.bincount(owner[good], minlength=len(texts))


def fit_characters(docs: DataFrame, text: str, label: str, sample_docs: int = SAMPLE_DOCS,
                   sample_chars: int = SAMPLE_CHARS) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-probability of each trigram bucket under each (BUCKETS x languages)."""
    ship(docs.sparkSession)
    labelled = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    sample = sampled(labelled.select(F.col(label).cast("string").alias("label"), F.xxhash64(label, text).alias("key"),
                                     F.substring(F.col(text), 1, sample_chars).alias("text")), "key", sample_docs, "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for lo, hi in slices(batch.column("text"), SLICE_BYTES):
                labels = batch.column("label").slice(lo, hi - lo).to_pylist()
                texts = batch.column("text").slice(lo, hi - lo).to_pylist()
                for name in sorted(set(labels)):
                    own = [t for t, x in zip(texts, labels) if x == name]
                    sums[name] = sums.get(name, 0) + np.bincount(_trigrams(own)[0], minlength=BUCKETS)
            for name, table in sums.items():
                buckets = np.flatnonzero(table)
                yield pa.record_batch([pa.array([name] * len(buckets), pa.string()), pa.array(buckets, pa.int32()),
                                       pa.array(table[buckets], pa.int64())], names=["label", "bucket", "n"])

    counts = (sample.select("label", "text").mapInArrow(frugal(count), "label string, bucket int, n bigint")
                    .groupBy("label", "bucket").agg(F.sum("n").alias("n")))
    found = counts.toArrow()              # bounded by the sample: at most labels x BUCKETS rows
    label_of = found.column("label").combine_chunks().dictionary_encode()
    names = sorted(label_of.dictionary.to_pylist())
    if not names:
        return [], np.zeros((BUCKETS, 0), dtype=np.float32)
    place = np.array([names.index(n) for n in label_of.dictionary.to_pylist()])[label_of.indices.to_numpy()]
    table = np.full((BUCKETS, len(names)), 0.05)
    table[found.column("bucket").to_numpy(), place] += found.column("n").to_numpy()
    return names, np.log(table / table.sum(axis=0)).astype(np.float32)


def score_texts(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """``rows`` (with ``text`` last to go) plus ``mean``: log-likelihood per trigram, and ``n`` trigrams."""
    ship(rows.sparkSession)
    keep = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in keep], "n bigint", "mean array<double>"])
    table = rows.sparkSession.sparkContext.broadcast(model)     # BUCKETS x languages numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = table.value
        for batch in batches:
            column = batch.column("text")
            for lo, hi in slices(column, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
                buckets, owner, n = _trigrams(texts)
                sums = np.stack([np.bincount(owner, weights=logs[buckets, k], minlength=len(texts))
                                 for k in range(logs.shape[1])], axis=1)
                mean = sums / np.maximum(n, 1)[:, None]
                offsets = pa.array(np.arange(0, mean.size + 1, mean.shape[1]), pa.int32())
                yield pa.record_batch(
                    [*[part.column(f.name) for f in keep], pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(mean.ravel(), pa.float64()))],
                    names=[*[f.name for f in keep], "n", "mean"])

    return rows.mapInArrow(frugal(run), schema)


def _softmax(logs: Column) -> Column:
    powers = let(logs, lambda x: F.transform(x, lambda v: F.exp(v - F.array_max(x))))
    return let(powers, lambda p: F.transform(p, lambda v: v / F.aggregate(p, F.lit(0.0), lambda s, y: s + y)))


def _summed(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.array(*[F.sum(F.col("p")[i]) for i in range(len(names))]).alias("c"))


def _smoothed(counts: Column, above: Column, weight: float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(counts, above, lambda c, a: (c + weight * a) / (total + F.lit(weight)))


def identify(docs: DataFrame, text: str = "text", declared: str | None = "lang", host: Column | str | None = "source",
             suffix: Column | None = None, label: str | None = "lang", key: tuple[str, ...] = ("doc_id", "text"),
             names: list[str] | None = None, model: np.ndarray | None = None, keep_unlabelled: bool = False) -> DataFrame:
    """One row per input row: ``__k1, __k2`` (hash of ``key``), the ``key`` columns but the text, language, posterior, kept."""
    if model is None:
        names, model = fit_characters(docs, text, label)
    ids = [c for c in key if c != text]
    host_col = F.lit("") if host is None else (F.col(host) if isinstance(host, str) else host)
    rows = keyed(docs, *key).select(
        "__k1", "__k2", *ids, F.coalesce(host_col.cast("string"), F.lit("")).alias("__host"),
        F.coalesce((F.lit("") if suffix is None else suffix).cast("string"), F.lit("")).alias("__suffix"),
        F.coalesce((F.lit("") if declared is None else F.col(declared)).cast("string"), F.lit("")).alias("__declared"),
        F.col(text).alias("text"))
    if not names:
        return rows.select("__k1", "__k2", *ids, F.lit(None).cast("string").alias("language"),
                           F.lit(0.0).alias("posterior"),
                           (F.lit(keep_unlabelled) & F.coalesce(F.col("text").rlike(LETTER), F.lit(False))).alias("kept"))
    uniform = math.log(1 / BUCKETS)
    scored = written(score_texts(rows, model), "language-scores")
    evidence = F.transform("mean", lambda m: m * F.least(F.col("n"), F.lit(TEMPER)))
    scored = scored.withColumn("p", _softmax(evidence))
    covered = (F.col("n") > 0) & (F.array_max("mean") > uniform)
    clear = scored.where(covered)
    # hot hosts shrink to one row per task before the shuffle
    hosts = written(_summed(clear, ["__host", "__suffix"], names), "hosts")
    whole = _summed(hosts.select(F.col("c").alias("p")), [], names).first()["c"]
    total = sum(x or 0.0 for x in whole)
    top = F.array(*[F.lit(((x or 0.0) + 1.0) / (total + len(names))) for x in whole])
    suffixes = _summed(hosts.select("__suffix", F.col("c").alias("p")), ["__suffix"], names).select(
        "__suffix", _smoothed(F.col("c"), top, SMOOTHING).alias("above"))
    priors = hosts.join(suffixes, "__suffix").select(
        "__host", "__suffix", _smoothed(F.col("c"), F.col("above"), SMOOTHING).alias("prior"))
    even = F.array(*[F.lit(1.0 / len(names))] * len(names))
    told = _summed(clear.where("__declared != ''"), ["__declared"], names).select(
        "__declared", _smoothed(F.col("c"), even, DECLARED_SMOOTHING).alias("told"))
    fused = spread_join(spread_join(scored, priors, ["__host", "__suffix"], "left"), told, ["__declared"], "left")
    logs = F.zip_with(F.zip_with(evidence, F.coalesce("prior", top), lambda e, p: e + F.log(p)),
                      F.coalesce("told", even), lambda e, d: e + F.log(d))
    languages = F.array(*[F.lit(n) for n in names])
    out = fused.select("__k1", "__k2", *ids, "n", covered.alias("covered"), _softmax(logs).alias("p"))
    posterior = F.array_max("p")
    return out.select(
        "__k1", "__k2", *ids,
        F.when(F.col("covered"), F.element_at(languages, F.array_position("p", posterior).cast("int"))).alias("language"),
        F.when(F.col("covered"), posterior).otherwise(0.0).alias("posterior"),
        ((F.col("n") > 0) & (~F.col("covered") | (posterior >= MIN_POSTERIOR))).alias("kept"))


def page_evidence(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``declared``, ``host``, ``suffix`` and ``text`` drawn from markup and address."""
    page, address = F.coalesce(F.col(html), F.lit("")), F.coalesce(F.col(url), F.lit(""))
    declared = F.lower(F.regexp_extract(page, r"""(?i)<html[^>]*\blang=["']?([A-Za-z]+)""", 1))
    host = F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    bare = F.regexp_replace(F.regexp_replace(page, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    return pages.select("*", F.nullif(declared, F.lit("")).alias("declared"), host.alias("host"),
                        F.substring_index(host, ".", -1).alias("suffix"), bare.alias("page_text"))
