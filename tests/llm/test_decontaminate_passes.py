"""Decontamination: words are cut once, lists meet without sorting, neighbours are compared at word ends."""

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import __spark_entry__  # noqa: E402, F401
from tests.llm import brute  # noqa: E402
from tierforge.llm import common, decontaminate  # noqa: E402

ITEMS = [(1, "a b c d e f g h i j k"), (2, "Solo"), (3, "ab c"), (4, "c ab"), (5, None), (6, "x x x")]
DOCS = [(1, "a b c d e f g h i j"), (2, "z a b c d e f g h i j k z"), (3, "a b c d e f g h i jj"), (4, "xa b c d e f g h i j"),
        (5, "SOLO"), (6, "solos"), (7, "ab c"), (8, "aab c"), (9, "ab cc"), (10, "c ab c ab"), (11, "x x x x"), (12, "x x"),
        (13, None), (14, ""), (15, "ab, c"), (16, "ab c"), (17, "c")]


def _searched(spark):
    k1, k2 = common.fingerprint("text")
    rows = spark.createDataFrame(DOCS, "doc_id bigint, text string").where("text is not null").select(
        k1.alias("k1"), k2.alias("k2"), "text")
    distinct, _ = decontaminate.windows(spark.createDataFrame(ITEMS, "item_id bigint, text string"))
    terms = distinct.select(F.explode("words").alias("term")).distinct()
    plan = decontaminate.plan_searches(distinct, decontaminate.term_frequencies(rows, terms))
    searches = common.written(plan.withColumn("wid", F.monotonically_increasing_id()), "test-searches")
    return decontaminate.build_index(rows, terms, decontaminate.WINDOW - 1), searches


def test_postings_hold_strings_and_lists_meet_without_a_sort(spark):
    """Arrays of words in a posting, and a sort-merge join of five keys over them, took executors beyond their memory."""
    index, searches = _searched(spark)
    assert not any(kind.startswith("array") for _, kind in index.dtypes)
    plan = decontaminate.phrase_matches(index, searches)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_documents_are_cut_into_words_once(spark, monkeypatch):
    """Items once, documents once (three times before: frequencies, postings, number of words)."""
    calls, plain = [], decontaminate.words
    monkeypatch.setattr(decontaminate, "words", lambda text: calls.append(1) or plain(text))
    docs, items = (spark.createDataFrame(x, f"{k} bigint, text string") for x, k in ((DOCS, "doc_id"), (ITEMS, "item_id")))
    found = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
             for r in decontaminate.contamination(docs, items).collect()}
    assert len(calls) == 2
    assert found == brute.op5(DOCS, ITEMS)
    assert {i for i, r in found.items() if r[4]} == {1, 2, 5, 7, 10, 11, 15, 16}
