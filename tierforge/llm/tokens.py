"""Token counts with overlap resynchronisation for huge documents.

A document of up to CHUNK characters is encoded as one text. A longer one is
encoded in chunks that overlap, each with character offsets. Neighbours are
spliced at a token boundary that both chunks have at the same place and that
is proven stable: a single space between visible characters, where the
tokenizer's pre-split always begins a new piece, so nothing on one side can
change the tokens on the other. If an overlap holds no such boundary, the
left chunk is extended and the overlap doubled, in the end to the whole rest.

A document that is encoded at once is cut at the same stable places, and each
distinct piece is encoded once per worker, as long as a cache of two
generations of CACHE_BYTES holds it.

Tokenizers that fold case and put words, digits and punctuation into tokens of
their own (``words_apart``) are cut finer: into words, small letters, apart
from punctuation. That holds for texts of plain Latin letters; others are cut
at spaces as above. A distinct word of letters goes straight to the
tokenizer's model: normal form and pre-tokens have nothing left to do.

Defined cases: a null or empty text has no tokens and no bytes; repeated rows
give repeated results; other columns may be null or bear any name; an empty
table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.llm.common import frugal, ship

CHUNK, OVERLAP = 32_768, 512      # characters
LIMIT = 1024                      # tokens; more are over the limit
CACHE_BYTES = 128 << 20           # of one generation of encoded pieces; a worker remembers two
ENTRY_BYTES = 230                 # of a cache entry besides its characters and ids
SLICE_BYTES = 2 << 20             # text that is worked on at once

# Begins a piece whatever stands around it (white space here includes all that the tokenizers call so).
_STABLE = re.compile(r"(?<=\S)(?= \S)")

_TOKENIZERS: dict[str, object] = {}
_LETTERS: dict[str, dict[int, str] | None] = {}
_CACHES: dict[str, _Cache] = {}

# Fixed value: the pattern by which such tokenizers part their text.
_WORDS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters and digits below U+0250, as a character class.
_ALNUM = "".join(f"{chr(c)}" for c in range(0x250) if chr(c).isalnum())
# A run of letters and digits, with an apostrophe if one stands alone before it; a run of other visible characters.
_FINE = re.compile(rf"[{_ALNUM}]+|'[{_ALNUM}]+|[^\s{_ALNUM}]+")
# Outside of these, letters, white space or normal forms may be judged otherwise by the tokenizer.
_PLAIN = re.compile("[\\t-\\r -~\xa1-\xac\xae-įı-ɏ‐-‧€]*")


class _Cache:
    """Ids of pieces (four bytes each) in two generations; a full one becomes the old one, pieces still in use move on from it."""

    def __init__(self, limit: int) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.bytes, self.limit = 0, limit

    def missing(self, wanted: set[str]) -> list[str]:
        """Pieces to be encoded, after those known were made young."""
        fresh = wanted.difference(self.young)
        if self.bytes > self.limit:
            self.young, self.old, self.bytes, fresh = {}, self.young, 0, wanted
        known = list(fresh.intersection(self.old))
        self.put(known, list(map(self.old.__getitem__, known)))
        return list(fresh.difference(known))

    def put(self, pieces: list[str], ids: list[bytes]) -> None:
        self.young.update(zip(pieces, ids))
        self.bytes += ENTRY_BYTES * len(pieces) + sum(map(len, pieces)) + sum(map(len, ids))


def tokenizer(path: str):
    """The tokenizer at ``path``, loaded once per Python worker, or until it forgets."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"    # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _TOKENIZERS[path] = t
    return _TOKENIZERS[path]


def letters(path: str) -> dict[int, str] | None:
    """How the tokenizer's model spells letters, if the tokenizer keeps ``words_apart``; else None."""
    if path not in _LETTERS:
        t = tokenizer(path)
        # the parts alone: the whole tokenizer, vocabulary and merges, takes tens of MB as JSON
        normalizer, pre_tokenizer = (json.loads(part.__getstate__()) if part else {} for part in (t.normalizer, t.pre_tokenizer))
        normal = [n["type"] for n in normalizer.get("normalizers", [])]
        first, *rest = pre_tokenizer.get("pretokenizers", []) or [{}]
        apart = (normal == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": _WORDS_APART}
                 and first.get("invert") and [(p["type"], p.get("use_regex"), p.get("add_prefix_space")) for p in rest]
                 == [("ByteLevel", False, False)] and type(t.model).__name__ == "BPE")
        _LETTERS[path] = {ord(c): t.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in _ALNUM if c.isalpha()} if apart else None
    return _LETTERS[path]


def cut(text: str) -> list[str]:
    """``text`` in pieces that tokenise independently; joined they give it back."""
    return _STABLE.split(text) if text else []


@lru_cache
def _added(path: str) -> list[str]:
    """Texts that the tokenizer takes as one token wherever they stand."""
    return [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]


def words(path: str, text: str) -> list[str]:
    """``text`` in words that tokenise independently, for ``words_apart``; white space between them is left out."""
    if not text:
        return []
    if _PLAIN.fullmatch(text) is None or any(t in text for t in _added(path)):
        return cut(text)
    return _FINE.findall(text.lower())


def forget() -> None:
    """Drop the encoded pieces and the tokenizers that this worker remembers (its next tasks may be of another stage)."""
    _CACHES.clear()
    _TOKENIZERS.clear()


def encoded(path: str, texts: Iterable[list[str]], cache_bytes: int = CACHE_BYTES) -> dict[str, bytes]:
    """A table with the ids (little-endian, four bytes each) of every piece in ``texts`` (lists of pieces)."""
    cache, t = _CACHES.setdefault(path, _Cache(cache_bytes)), tokenizer(path)
    todo, spelling = cache.missing(set().union(*texts)), letters(path)
    if spelling is not None:
        # words of small letters only, all below U+0250
        tokenize, alone, others = t.model.tokenize, [], []
        for w in todo:
            (alone if w.isalpha() and w.islower() and (w.isascii() or max(w) < "\u0250") else others).append(w)
        cache.put(alone, [array("I", [x.id for x in tokenize(w if w.isascii() else w.translate(spelling))]).tobytes() for w in alone])
        todo = others
    for i in range(0, len(todo), 4096):
        part = todo[i:i + 4096]
        cache.put(part, [array("I", e.ids).tobytes() for e in t.encode_batch_fast(part, add_special_tokens=False)])
    return cache.young


def spelled(table: dict[str, bytes], pieces: list[str]) -> bytes:
    """The ids of a text, joined from those of its pieces."""
    if len(pieces) < 2:
        return table[pieces[0]] if pieces else b""
    return b"".join(itemgetter(*pieces)(table))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column that hold about ``limit`` bytes each (one row at least)."""
    if len(column) == 0:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(ends):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right"))
        hi = max(hi, lo + 1)
        yield lo, hi
        lo = hi


def count_huge(encode: Callable[[str], tuple[list[int], list[int]]], text: str, chunk: int = CHUNK,
               overlap: int = OVERLAP) -> int:
    """Tokens of a text longer than ``chunk``, by overlapping chunks.

    ``encode(text)`` gives the tokens' ids and start offsets.
    """
    counted, begin = 0, 0                 # tokens before ``begin``, a stable boundary
    while True:
        end, shared = min(begin + chunk, len(text)), overlap
        while True:
            _, left = encode(text[begin:end])
            if end == len(text):
                return counted + len(left)
            low = max(begin + 1, end - shared)
            _, right = encode(text[low:end])
            # a boundary must be seen by both chunks, and be stable
            common = np.intersect1d(np.asarray(left, dtype=np.int64) + begin, np.asarray(right, dtype=np.int64) + low)
            place = next((int(p) for p in common[::-1] if p > begin and _STABLE.match(text, int(p))), None)
            if place is not None:
                break
            end, shared = min(end + shared, len(text)), 2 * shared
        counted += int(np.searchsorted(np.asarray(left), place - begin))
        begin = place


def _offsets(path: str) -> Callable[[str], tuple[list[int], list[int]]]:
    def encode(text: str) -> tuple[list[int], list[int]]:
        e = tokenizer(path).encode(text, add_special_tokens=False)
        return e.ids, [a for a, _ in e.offsets]

    return encode


def count_texts(path: str, texts: list[str | None], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    pieces = [cut(t) if t and len(t) <= chunk else [] for t in texts]
    table = encoded(path, pieces)
    return [count_huge(_offsets(path), t, chunk, overlap) if t and len(t) > chunk else len(spelled(table, p)) // 4
            for t, p in zip(texts, pieces)]


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT,
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit. A map without a shuffle."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for lo, hi in slices(column):
                part = column.slice(lo, hi - lo)
                n = count_texts(path, part.to_pylist(), chunk, overlap)
                size = pc.fill_null(pc.binary_length(part), 0).cast(pa.int64())
                yield pa.record_batch([batch.column("doc_id").slice(lo, hi - lo), size, pa.array(n, pa.int64())],
                                      names=["doc_id", "n_bytes", "n_tokens"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(frugal(count), f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
