"""Defined cases that the docstrings promise: empty pipelines, repeated rows, null ids, single huge texts."""

import os
import sys

import public_tokenizers
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from tierforge.llm import decontaminate, exact_recipes, language, mixing, pii, secret_markov, suffix_shards, tokens  # noqa: E402

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_pipeline_of_an_empty_table(spark, sf_dir, docs, tmp_path):
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.collect() == [] and {"doc_id", "start", "length", "sequence_id"} <= set(packed.columns)
    empty = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, str(tmp_path)).columns == empty.columns


def _some(docs):
    return docs.where("doc_id < 30").unionByName(docs.where("doc_id < 30")).unionByName(
        docs.limit(2).withColumn("doc_id", F.lit(None).cast("bigint"))).repartition(3)


@pytest.mark.parametrize("report, columns", [
    (pii.pii_report, ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")),
    (secret_markov.secret_report, ("n_assign", "n_access", "n_hex", "base_sha256"))])
def test_repeated_rows_and_null_ids_in_span_reports(docs, report, columns):
    rows = _some(docs)
    found = report(rows).select("doc_id", *columns).collect()
    assert len(found) == rows.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add(tuple(r[c] for c in columns))
    assert all(len(v) == 1 for k, v in by_id.items() if k is not None)


def test_repeated_rows_and_null_ids_in_language(docs):
    rows = _some(docs)
    names, model = language.fit_characters(docs, "text", "lang")
    found = language.identify(rows, names=names, model=model).collect()
    assert len(found) == rows.count()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add((r.language, r.posterior, r.kept))
    assert all(len(v) == 1 for k, v in by_id.items() if k is not None)


def test_repeated_rows_and_null_ids_in_decontamination(spark, sf_dir, docs):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _some(docs)
    found = decontaminate.contamination(rows, items).collect()
    expected = brute.op5([(r.doc_id, r.text) for r in docs.where("doc_id < 30").collect()], [(r.item_id, r.text) for r in items.collect()])
    assert len(found) == rows.count()
    cols = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert all(tuple(r[c] for c in cols) == expected[r.doc_id] for r in found if r.doc_id is not None)


HUGE = {"digits": "1234567890" * 50_000, "dots": "1.2.3.4." * 50_000, "hex": "0af3" * 100_000, "word": "x" * 600_000,
        "words": "lorem ipsum " * 60_000, "spaces": " \t\n" * 150_000}


def test_single_huge_texts(spark):
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(HUGE.values())], "doc_id bigint, text string, source string").repartition(3)
    pairs = list(enumerate(HUGE.values()))
    found = {r.doc_id: (r.n_email, r.n_card, r.n_phone) for r in pii.pii_report(df).collect()}
    assert found == {i: (0, 0, 0) for i, _ in pairs}        # runs too long for a card, no @, no +
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_recipes.exact_groups(df).collect()}
    assert found == brute.op6(pairs)
    sizes = {r.doc_id: r["size"] for r in mixing.mix(df).collect()}
    assert sizes == {i: len(t.split()) for i, t in pairs}
    counts = {r.doc_id: r.n_bytes for r in tokens.token_counts(df, BYTE_BPE).collect()}
    assert counts == {i: len(t) for i, t in pairs}
    # every such text repeats itself
    removed = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_shards.remove_repeats(df).collect()}
    assert removed == {i: (len(t), len(t)) for i, t in pairs}
