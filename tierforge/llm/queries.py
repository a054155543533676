"""Registered queries: one per training-data operator over its whole table, and operator 2 over pages as well."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm import (
    decontaminate, exact_recipes, hard_negatives, language, mixing, packing, pii, prob_minhash, repair, secret_markov,
    substring_levels, suffix_shards, tokens)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark, sf_dir):
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op2_language(spark, sf_dir):
    found = language.identify(_table(spark, sf_dir, "documents"), keep_unlabelled=True)
    return found.select("doc_id", "language", "posterior", "kept")


def language_pages(spark, sf_dir):
    """Operator 2 over raw pages: markup, address suffix and host as evidence, the model fitted on other rows (documents)."""
    names, model = language.fit_characters(_table(spark, sf_dir, "documents"), "text", "lang")
    pages = language.page_evidence(_table(spark, sf_dir, "pages"))
    found = language.identify(pages, text="page_text", declared="declared", host="host", suffix=F.col("suffix"),
                              key=("page_id", "page_text"), names=names, model=model)
    return found.select("page_id", "language", "posterior", "kept")


def op3_suffix_shards(spark, sf_dir):
    return suffix_shards.remove_repeats(_table(spark, sf_dir, "documents")).drop("spans")


def op4_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_decontaminate(spark, sf_dir):
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_exact_recipes(spark, sf_dir):
    return exact_recipes.exact_groups(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark, sf_dir):
    return tokens.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_secret_markov(spark, sf_dir):
    return secret_markov.secret_report(_table(spark, sf_dir, "documents"))


def op9_substring_levels(spark, sf_dir):
    return substring_levels.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_prob_minhash(spark, sf_dir):
    return prob_minhash.near_classes(_table(spark, sf_dir, "documents"))


def op11_mixing(spark, sf_dir):
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op12_repair(spark, sf_dir):
    return repair.repair(repair.damaged(_table(spark, sf_dir, "conversations")), present="present")


def op13_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    """The first ten operators."""
    return {f.__name__: f for f in (
        op1_pii, op2_language, op3_suffix_shards, op4_packing, op5_decontaminate, op6_exact_recipes, op7_token_counts, op8_secret_markov,
        op9_substring_levels, op10_prob_minhash)}


def later_queries() -> dict[str, Query]:
    """The operators that came after them, and operator 2 over pages."""
    return {f.__name__: f for f in (op11_mixing, op12_repair, op13_hard_negatives, language_pages)}
