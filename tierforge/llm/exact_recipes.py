"""Exact duplicates by content-defined chunk recipes.

Every normalised text is cut into chunks at places that its own characters
choose. A chunk's identifier is a tuple of 64-bit hashes, verified over the
whole corpus: equal contents are merged (before the shuffle, so copies move
once per task), and identifiers that stand for two contents widen the tuple.
Documents are then compared by their ordered identifier lists, 16 bytes for
some hundreds of characters; the texts themselves don't move again.

Defined cases: a null text counts as empty, and empty texts equal each other.
Of equal texts the smallest ``doc_id`` stays; a null id stays only if the
group has no other. A row repeated with the same id stays as often as it
occurs. Other columns may be null or bear any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.common import SPACE_CLASS, spread_join

# A chunk ends behind three characters of the cut class (code points that are
# a multiple of 8, below 256), not before MIN_CHUNK, or at MAX_CHUNK.
MIN_CHUNK, MAX_CHUNK = 512, 8192
_CUT = "".join(f"\\x{c:02x}" for c in [*range(0x20, 0x7F, 8), *range(0xA0, 0x100, 8)])
CHUNK_PATTERN = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?<=[{_CUT}]{{3}})|.{{1,{MAX_CHUNK}}}"


def normalised(text: Column) -> Column:
    """White-space runs as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", " ")


def chunks(text: Column) -> Column:
    """Content-defined chunks; joined they give ``text`` back."""
    return F.regexp_extract_all(text, F.lit(CHUNK_PATTERN), F.lit(0))


def _identifier(chunk: Column, width: int, bits: int) -> Column:
    return F.array(*[F.shiftrightunsigned(F.xxhash64(F.lit(f"chunk{i}"), chunk), 64 - bits) if bits < 64
                     else F.xxhash64(F.lit(f"chunk{i}"), chunk) for i in range(width)])


def verified_width(texts: DataFrame, width: int = 2, bits: int = 64) -> int:
    """The least number of hashes, from ``width`` on, that tells all chunk contents apart.

    ``texts`` has a column ``text`` of normalised texts. One bounded job per
    width; a second pass happens only if two contents share an identifier.
    """
    while True:
        pieces = texts.select(F.explode(chunks(F.col("text"))).alias("chunk"))
        contents = pieces.select(_identifier(F.col("chunk"), width, bits).alias("id"), "chunk").distinct()
        clash = contents.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if clash.limit(1).count() == 0:
            return width
        width += 1


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 2,
                 bits: int = 64, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``carry`` columns, doc_id, keep_id, group_size, kept, text_sha256.

    ``width`` hashes of ``bits`` bits identify a chunk at first (small values
    serve tests of the verification).
    """
    rows = docs.select(*carry, F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("text"))
    width = verified_width(rows.select("text"), width, bits)
    recipes = rows.select(
        *carry, "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.flatten(F.transform(chunks(F.col("text")), lambda c: _identifier(c, width, bits))).alias("recipe"))
    groups = recipes.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"),
                                           F.count(F.lit(1)).alias("group_size"))
    return spread_join(recipes, groups, ["recipe"]).select(
        *carry, "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
