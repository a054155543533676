"""Benchmark decontamination over a distributed positional inverted index.

Test items become windows of consecutive words. The index holds postings
(term, text key, position, neighbouring words) of the training corpus for the
terms that searches start from: of every window its two rarest terms, by
corpus frequency. A search takes the posting lists of these two terms, shifts
each by the term's offset in the window, compares the words around the rarest
term with the window's, and intersects the shifted lists.

Built-in functions only. Each text is cut into words once, and its folded words
are written for all later passes. Postings are keyed by a 128-bit hash of the
text, so copies of a text share one set of postings, and a hot term's list is
spread over all partitions by (window, text, start). Neighbouring words are
strings with a space at either end, which are compared by their ends alone;
lists are intersected by hashes of the checked places, which fit in memory by
the task. The test set is collected in blocks of at most TERM_BLOCK terms; the
corpus never is.

Defined cases: a null text has no words (no hit); a document or item without
words matches nothing; items with null or repeated ids count by distinct
non-null id; an empty benchmark leaves every document clean; repeated rows
give repeated results; other columns may be null or bear any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierforge.llm.common import bounded_broadcast, fingerprint, let, spread_join, written

# Fixed value: a word, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
TERM_BLOCK = 50_000        # test terms that one pass over the corpus looks up
BROADCAST_ROWS = 500_000   # rows of (term, numbers) a join may broadcast
KEY = ("k1", "k2")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _words_of(texts: DataFrame) -> Column:
    """The words of ``texts``: of its ``folded`` (words joined by one space), if it has that, else of its ``text``."""
    if "folded" not in texts.columns:
        return words(F.col("text"))
    return F.when(F.col("folded") == "", F.array().cast("array<string>")).otherwise(F.split("folded", " "))


def _spaced(ws: Column) -> Column:
    """The words with a space before, between and behind them; one space if there are none."""
    return F.array_join(F.concat(F.array(F.lit("")), ws, F.array(F.lit(""))), " ")


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(window, words)`` of the distinct windows, and ``(window, item_id)``.

    ``window`` is the joined words themselves, so equal windows of several
    items are searched once. An item shorter than ``size`` is one window.
    """
    w = F.col("w")
    every = F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - size + 1, F.lit(1))), lambda i: F.slice(w, i, size))
    ).when(F.size(w) > 0, F.array(w))
    rows = (items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w"))
                 .select("item_id", F.explode(every).alias("words"))
                 .withColumn("window", F.array_join("words", " ")))
    return rows.select("window", "words").distinct(), rows.select("window", "item_id").distinct()


def _blocks(terms: DataFrame) -> list[list[str]]:
    """The distinct ``term`` values in lists of about TERM_BLOCK (the test set's vocabulary)."""
    count = terms.count()
    n = max(1, -(-count // TERM_BLOCK))
    part = F.pmod(F.xxhash64("term"), F.lit(n))
    return [[r["term"] for r in terms.where(part == b).select("term").collect()] for b in range(n)] if count else []


def term_frequencies(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n)``: occurrences in the corpus of the test terms that occur at all.

    ``texts`` has ``text`` or ``folded``; ``terms`` has distinct ``term``.
    """
    out = None
    for block in _blocks(terms):
        hits = F.filter(_words_of(texts), lambda w: w.isin(block))
        part = texts.select(F.explode(hits).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return terms.select("term", F.lit(0).cast("bigint").alias("n")).limit(0) if out is None else out


def plan_searches(distinct: DataFrame, frequency: DataFrame, phrases: bool = True) -> DataFrame:
    """``(window, words, first, second)``: the rarest two (offset, term) of each window.

    ``second`` is null for one-word windows. A window with a term that the
    corpus lacks can't occur as a phrase and is left out; for proximity (not
    ``phrases``) it is searched by its terms that do occur, null if only one does.
    """
    terms = distinct.select("window", "words", F.posexplode("words").alias("offset", "term"))
    ranked = terms.join(frequency, "term").groupBy("window", "words").agg(
        F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("t"))   # at most one window's words
    return (ranked.where(F.size("t") == F.size("words")) if phrases else ranked).select(
        "window", "words", F.col("t")[0].alias("first"), F.get("t", F.lit(1)).alias("second"))


def _hits(block: list[str], context: int):
    def postings(ws: Column) -> Column:
        places = F.filter(F.transform(ws, lambda w, i: F.when(w.isin(block), i)), lambda i: i.isNotNull())
        return F.transform(places, lambda i: F.struct(
            F.get(ws, i).alias("term"), i.alias("pos"),
            _spaced(F.slice(ws, F.greatest(i - context, F.lit(0)) + 1, F.least(i, F.lit(context)))).alias("before"),
            _spaced(F.slice(ws, i + 2, context)).alias("after")))

    return postings


def build_index(texts: DataFrame, terms: DataFrame, context: int) -> DataFrame:
    """Postings ``(term, k1, k2, pos, before, after)`` of ``terms``; ``before, after``: ``context`` words to either side.

    ``texts`` has ``k1, k2`` and ``text`` or ``folded``. Copies of a text give one posting.
    """
    out = None
    for block in _blocks(terms):
        rows = texts.select(*KEY, F.explode(let(_words_of(texts), _hits(block, context))).alias("p"))
        part = rows.select("p.term", *KEY, "p.pos", "p.before", "p.after")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return texts.select(F.lit("").alias("term"), *KEY, F.lit(0).alias("pos"),
                            F.lit("").alias("before"), F.lit("").alias("after")).limit(0)
    return out.dropDuplicates(["term", *KEY, "pos"])


def _list(index: DataFrame, searches: DataFrame, which: str, *columns: str) -> DataFrame:
    """Posting lists of the windows' ``which`` terms, shifted to window starts (below 0 if the window would begin before the text).

    ``length`` is the window's, ``ahead`` and ``behind`` are its words before and after the term.
    """
    w, offset = F.col("words"), F.col(f"{which}.offset")
    side = bounded_broadcast(written(searches.where(F.col(which).isNotNull()).select(
        "wid", F.size(w).alias("length"), F.col(f"{which}.term").alias("term"), offset.alias("offset"),
        _spaced(F.slice(w, F.lit(1), offset)).alias("ahead"), _spaced(F.slice(w, offset + 2, F.size(w))).alias("behind")),
        f"search-{which}"), BROADCAST_ROWS)
    return index.join(side, "term").select("wid", "length", *KEY, (F.col("pos") - F.col("offset")).alias("start"), *columns)


def phrase_matches(index: DataFrame, searches: DataFrame) -> DataFrame:
    """Exact occurrences ``(wid, k1, k2, start, length)`` of the searched windows.

    ``searches``: plan_searches() with a numeric ``wid``. A list holds a place
    once, so that the lists meet one to one; of the first only the places whose
    neighbouring words are the window's are kept in memory.
    """
    place = ["wid", *KEY, "start"]
    around = F.col("before").endswith(F.col("ahead")) & F.col("after").startswith(F.col("behind"))
    first = _list(index, searches, "first", "before", "after", "ahead", "behind").where((F.col("start") >= 0) & around).select(*place, "length")
    second = _list(index, searches, "second").where("start >= 0").select(*place)
    both = second.join(first.where("length > 1").hint("shuffle_hash"), place)
    return both.select(*place, "length").unionByName(first.where("length = 1"))


def proximity_matches(index: DataFrame, searches: DataFrame, slop: int) -> DataFrame:
    """``(wid, k1, k2)`` where a window's two rarest terms lie within ``slop`` words of their places.

    ``searches``: plan_searches() without ``phrases``. A one-word window matches
    wherever its word is; a longer one of which a single term occurs, nowhere.
    Shifted positions are compared by buckets of ``slop`` words and their
    neighbours, an equi-join.
    """
    bucket = F.floor(F.col("start") / F.lit(max(slop, 1)))
    lists = _list(index, searches, "first", "pos")
    first = lists.select("wid", *KEY, F.col("start").alias("a"), F.col("pos").alias("p"), bucket.alias("b"))
    second = _list(index, searches, "second", "pos").select(
        "wid", *KEY, F.col("start").alias("c"), F.col("pos").alias("q"),
        F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b"))
    # a window's repeated term needs two places
    near = spread_join(first, second, ["wid", *KEY, "b"]).where((F.abs(F.col("a") - F.col("c")) <= slop) & (F.col("p") != F.col("q")))
    single = lists.where("length = 1").select("wid", *KEY)
    return near.select("wid", *KEY).unionByName(single).distinct()


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text",
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``carry`` columns, doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    k1, k2 = fingerprint(F.coalesce(F.col(text), F.lit("")))
    cut = docs.select(*carry, F.col(doc_id).alias("doc_id"), k1.alias("k1"), k2.alias("k2"), words(F.col(text)).alias("words"))
    # the words are cut once: all passes read this table
    rows = written(cut.select(*carry, "doc_id", *KEY, F.size("words").cast("bigint").alias("n_words"),
                              F.array_join("words", " ").alias("folded")), "words")
    hits = text_hits(rows, items, item_id, item_text)
    out = spread_join(rows.select(*carry, "doc_id", *KEY, "n_words"), hits, KEY, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return out.select(*carry, "doc_id", "n_words", n_hit.alias("n_hit"),
                      F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
                      F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))


def text_hits(rows: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(k1, k2, n_hit, n_items, items)`` of the texts that hold a window; ``rows`` has ``k1, k2`` and ``text`` or ``folded``."""
    distinct, owners = windows(items, item_id, item_text)
    texts = rows.select(*KEY, "folded" if "folded" in rows.columns else "text")
    frequency = term_frequencies(texts, distinct.select(F.explode("words").alias("term")).distinct())
    # numbered once in a written table: the numbers can't change on a retry
    searches = written(plan_searches(distinct, frequency).withColumn("wid", F.monotonically_increasing_id()),
                       "searches")
    terms = searches.select(F.explode(F.array_compact(F.array("first.term", "second.term"))).alias("term")).distinct()
    index = written(build_index(texts, terms, WINDOW - 1), "postings")
    matches = written(phrase_matches(index, searches), "matches")
    covered = (matches.select(*KEY, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("p"))
                      .distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit")))
    owned = bounded_broadcast(written(searches.select("wid", "window").join(owners, "window")
                                      .select("wid", "item_id").where("item_id is not null"), "owners"), BROADCAST_ROWS)
    named = (matches.select("wid", *KEY).distinct().join(owned, "wid")
                    .groupBy(*KEY).agg(F.collect_set("item_id").alias("ids")))     # at most the items
    ids = F.array_sort(F.transform("ids", lambda i: i.cast("string")))
    return covered.join(named, list(KEY), "left").select(
        *KEY, "n_hit", F.size(F.coalesce("ids", F.array().cast(named.schema["ids"].dataType))).cast("bigint").alias("n_items"),
        F.array_join(ids, ",").alias("items"))
