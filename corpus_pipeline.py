"""A corpus pipeline over ``documents``: five stages, each one operator of ``tierforge.llm``.

Every stage is a function of (spark, docs, sf_dir) and returns a DataFrame; a
runner writes it as Parquet and gives it to the next one. All stages but the
last return the columns of their input, without the rows they drop.

Defined cases: as the operators document them. Null texts have no language and
go in the first stage; an empty table passes all stages as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm import decontaminate, exact_recipes, language, packing, prob_minhash
from tierforge.llm.common import keyed, without, written

_KEY = ("__k1", "__k2")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is clear or unknown to the model; the declared language and the source are evidence."""
    return without(keyed(docs, "doc_id", "text"), language.identify(docs, keep_unlabelled=True))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (up to white space) the one with the smallest id."""
    rows = keyed(docs, "doc_id", "text")
    return without(rows, exact_recipes.exact_groups(rows, carry=_KEY))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    rows = keyed(docs, "doc_id", "text")
    return without(rows, prob_minhash.near_classes(rows, carry=_KEY))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    rows = keyed(docs, "doc_id", "text")
    found = decontaminate.contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=_KEY)
    return without(rows, found.select(*_KEY, (~F.col("contaminated")).alias("kept")))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pack", pack_documents),
]

# Trained models, registers and tokenizers are beyond SQL; the tests hold run()
# against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
