"""Mixing sources to target weights by capped water-filling.

Every source has a weight and may be repeated at most ``max_epochs`` times. A
budget of words is dealt by weight; sources above their cap are clamped there
and the excess goes to the open ones in proportion to their weights, until no
source is above (each round is one aggregate over the table of sources, of
which three numbers reach the driver). Sizes and weights are integers, so the
rounds compare exactly.

A target is then sampled as whole repetitions of the source and a fractional
one: the documents of a source stand in a seeded order (over all tasks, by
range partitions; a source that holds most of the rows is split by that order)
and the first ones are taken once more until the target's rest is used up. The
document at the border is taken in part, so a source's words equal its target
rounded to a whole number, and reruns agree.

Defined cases: a null text has no words; a null source is a source of its own,
the last one; a source without words has target 0; repeated rows are taken as
separate documents, rows equal in id and size in any order among themselves;
a null id is an id like others; an empty table gives an empty table; other
columns may be null or bear any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierforge.llm.common import written
from tierforge.operators.keys import surrogate_key
from tierforge.operators.ranged import ordered_table

WORD = r"[^\x20\x09-\x0D]+"       # a word of the sizes
WEIGHTS = (3, 1, 2)               # of the sources in order, repeating
SHARE = (3, 2)                    # the budget as a fraction of all words
MAX_EPOCHS = 2
SEED = "mix"


def words(text: Column) -> Column:
    """Number of words of a text (bigint; null has none)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cycled_weights(sources: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``sources`` plus ``weight``: the given weights in turn, sources in order of code points, null last."""
    ranked = surrogate_key(sources.withColumn("__null", F.col("source").isNull()), ["__null", "source"], "__rank")
    place = F.pmod(F.col("__rank") - 1, F.lit(len(weights))).cast("int") + 1
    cycle = F.array(*[F.lit(int(w)).cast("bigint") for w in weights])
    return ranked.select(*sources.columns, F.element_at(cycle, place).alias("weight"))


def _exact(value: int) -> Column:
    return F.lit(Decimal(value)).cast("decimal(38,0)")


def water_fill(sources: DataFrame, share: tuple[int, int] = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight: integers >= 0) plus ``target`` (double).

    The budget is ``share`` (numerator, denominator) of all sizes; no target is
    above ``max_epochs`` times its source's size. If all sources end clamped,
    the rest of the budget is left over.
    """
    up, down = share
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    size, open_weight, clamped = int(total["size"] or 0), int(total["weight"] or 0), 0
    above, level = F.lit(True), 0.0
    while open_weight:
        # words per unit of weight, as a fraction of integers
        words_left, weight = up * size - down * clamped, down * open_weight
        above, level = F.col("weight") * _exact(words_left) > cap * _exact(weight), words_left / weight
        found = sources.agg(F.sum(F.when(above, cap)).alias("clamped"),
                            F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        now = int(found["clamped"] or 0), int(found["open"] or 0)
        if now == (clamped, open_weight):
            break
        clamped, open_weight = now
        if not open_weight:
            above = F.lit(True)
    share_of_level = F.lit(float(level)) * F.col("weight").cast("double")
    return sources.withColumn("target", F.when(above & (F.col("weight") > 0), cap.cast("double")).otherwise(share_of_level))


def mix(docs: DataFrame, weights: Sequence[int] | DataFrame = WEIGHTS, share: tuple[int, int] = SHARE,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED, doc_id: str = "doc_id", text: str = "text",
        source: str = "source", carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken, n_whole, n_part, ``carry``.

    ``weights`` are dealt to the sources in turn, or a table (source, weight);
    sources that it lacks weigh nothing. ``n_whole`` counts whole repetitions,
    ``n_part`` the words of one more that is taken in part; ``taken`` = words
    of both. ``carry`` names columns to pass through (they move with the rows).
    """
    size = words(F.col(text))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"),
                           size.cast("string")))
    rows = docs.select(F.col(source).cast("string").alias("__source"), F.col(doc_id).alias("__id"), size.alias("__size"),
                       order.alias("__order"), F.monotonically_increasing_id().alias("__row"),
                       *[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)])
    table = ordered_table(rows, ["__source", "__order", "__id", "__size", "__row"])

    # words of each source in each range partition: at most partitions + sources rows
    parts = table.groupBy(F.col("__source").alias("source"), F.col("__p").alias("part")).agg(F.sum("__size").alias("words"))
    parts = written(parts, "mix-parts")
    sources = written(parts.groupBy("source").agg(F.sum("words").alias("source_size")), "mix-sources")
    if isinstance(weights, DataFrame):
        given = weights.groupBy(F.col("source").alias("__s")).agg(F.sum("weight").cast("bigint").alias("weight"))
        weighed = sources.join(given, F.col("source").eqNullSafe(F.col("__s")), "left").select(
            "source", "source_size", F.coalesce("weight", F.lit(0).cast("bigint")).alias("weight"))
    else:
        weighed = cycled_weights(sources, weights)
    filled = water_fill(written(weighed, "mix-weights"), share, max_epochs)

    whole_words = F.floor(F.col("target") + 0.5).cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(whole_words / F.col("source_size"))).otherwise(0).cast("bigint")
    filled = filled.select(F.col("source").alias("__s"), "source_size", "target", whole.alias("__whole"),
                           (whole_words - whole * F.col("source_size")).alias("__rest"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("part")) - F.col("words")
    begins = parts.select("source", "part", before.alias("__begin")).join(
        filled, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")

    running = F.sum("__size").over(Window.partitionBy("__p", "__source").orderBy("__pos")) - F.col("__size")
    placed = table.withColumn("__running", running).join(
        begins, (F.col("__p") == F.col("part")) & F.col("__source").eqNullSafe(F.col("source")))
    extra = F.greatest(F.lit(0), F.least(F.col("__size"), F.col("__rest") - F.col("__begin") - F.col("__running")))
    filled_up = (extra == F.col("__size")) & (F.col("__size") > 0)
    return placed.withColumn("__extra", extra.cast("bigint")).select(
        F.col("__id").alias("doc_id"), F.col("__size").alias("size"), "source_size", "target",
        (F.col("__whole") * F.col("__size") + F.col("__extra")).alias("taken"),
        (F.col("__whole") + F.when(filled_up, 1).otherwise(0)).cast("bigint").alias("n_whole"),
        F.when(filled_up, 0).otherwise(F.col("__extra")).cast("bigint").alias("n_part"),
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)])


def mixed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mix itself: one row (doc_id, repetition, text) for every repetition of a document.

    Whole repetitions keep the text as it is; a partial one, the last, holds
    the first words joined by spaces.
    """
    plan = mix(docs, doc_id=doc_id, text=text, carry=[text], **options).withColumnRenamed(text, "text")
    repeats = F.col("n_whole") + (F.col("n_part") > 0).cast("bigint")
    rows = plan.where(repeats > 0).withColumn("repetition", F.explode(F.sequence(F.lit(1).cast("bigint"), repeats)))
    head = F.slice(F.regexp_extract_all(F.col("text"), F.lit(WORD), 0), 1, F.greatest(F.col("n_part"), F.lit(1)).cast("int"))
    return rows.select("doc_id", "repetition", F.when(F.col("repetition") <= F.col("n_whole"), F.col("text"))
                       .otherwise(F.array_join(head, " ")).alias("text"))
