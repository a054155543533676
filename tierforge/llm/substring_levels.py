"""Substring dedup by level-wise doubling of repeated word windows.

Goal: windows of ``target`` words whose word sequence also starts earlier in
the corpus (smaller document id, or earlier in the same document); every word
they cover goes.

Levels have lengths base, 2 * base, ... up to ``target``. At a level every
window that is still alive elects the least-hashed run of that length inside
it. Equal windows elect equal runs, so a window whose elected run occurs only
once dies there without ever being moved; only survivors are extended to twice
the length, and the loop ends when none are left or the target is reached,
where the elected run is the window itself. Elected runs are few (about one in
six positions for 10 of 20 words).

Every level is a Spark shuffle of hashes: runs of equal hash meet in one part,
after each task has merged its own. At the target level 96-bit hashes decide
and the smallest (document, position) is the first occurrence; occurrences
that a task sees beside an earlier one are settled before the shuffle, so a
hot passage sends one entry per task.

Defined cases: a null text has no words; texts below ``target`` words keep all;
rows that repeat id and text count as one document; a null id counts as the
largest; ids are integers; other columns may be null or bear any name;
an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.llm import blobs
from tierforge.llm.common import frugal, keyed, parts_for, ship
from tierforge.llm.hashing import joined, mix, ranged, text_bytes, window_hashes, word_bounds
from tierforge.llm.tokens import slices

BASE, TARGET = 10, 20
SLICE_BYTES = 2 << 20
NO_ID = np.iinfo(np.int64).max

# Hash columns, place (two halves), | entries per document, k1, k2 (and id) of documents.
# A level below the target only filters, so 48 bits serve it; the target takes 96 bits.
_LEVEL = ("<u4", "<u2", "<u2", "<u2", "<u4", "<i8", "<i8")
_OPEN = ("<u8", "<u4", "<u2", "<u2", "<u4", "<i8", "<i8", "<i8")
_RUN = "k1 bigint, k2 bigint, at int, n int"


class _Words:
    """The words of some rows as hashes, and the windows of ``target`` words inside one row."""

    def __init__(self, column: pa.Array, target: int) -> None:
        data, starts = text_bytes(column)
        lo, hi, self.row = word_bounds(data, starts)
        units = data.astype(np.uint64) + np.uint64(1)
        length = (hi - lo).astype(np.uint64)
        self.first = mix(ranged(units, lo, hi, 0) + length)
        self.second = mix(ranged(units, lo, hi, 1) ^ length)
        count = np.bincount(self.row, minlength=len(column))
        self.begin = np.concatenate([[0], np.cumsum(count)])      # first word of each row
        ends = self.row[target - 1:] if len(self.row) >= target else self.row[:0]
        self.windows = np.flatnonzero(self.row[:len(ends)] == ends)

    def elect(self, windows: np.ndarray, length: int, target: int) -> tuple[np.ndarray, np.ndarray]:
        """The elected place (a word's number) of each window, and all runs' hashes."""
        runs = window_hashes(self.first, length)
        width = target - length + 1
        if len(windows) == 0:
            return windows, runs
        best, value = windows.copy(), runs[windows]
        for step in range(1, width):
            other = runs[windows + step]
            better = other < value
            best[better] = windows[better] + step
            value = np.where(better, other, value)
        return best, runs

    def place(self, words: np.ndarray) -> np.ndarray:
        return words - self.begin[self.row[words]]


def _alive(words: _Words, lists: list, lengths: list[int], target: int) -> np.ndarray:
    """Windows whose elected run of the last level is among the rows' surviving places."""
    mark = np.zeros(len(words.row) + 1, dtype=bool)
    for r, places in enumerate(lists):
        if places:
            mark[words.begin[r] + np.asarray(places, dtype=np.int64)] = True
    best, _ = words.elect(words.windows, lengths[-1], target)
    return words.windows[mark[best]]


def _send(part: np.ndarray, doc: np.ndarray, hashes: list[np.ndarray], place: np.ndarray,
          keys: list[np.ndarray]) -> list[tuple[int, bytes]]:
    """Blobs of hashes and places, by document, with the keys of the documents they name."""
    order = np.lexsort((place, doc))
    out = []
    for p, (d, at, *share) in blobs.deal(part[order], [c[order] for c in (doc, place, *hashes)]):
        named, count = np.unique(d, return_counts=True)
        out.append((p, blobs.pack([*share, (at & 0xFFFF).astype("<u2"), (at >> 16).astype("<u2"), count.astype("<u4"),
                                   *[k[named] for k in keys]])))
    return out


def _receive(batches: Iterator[pa.RecordBatch], dtypes: tuple[str, ...]) -> list[np.ndarray]:
    """Two hash columns, place, and the keys of every entry."""
    found = []
    for batch in batches:
        for b in batch.column("blob"):
            one, two, low, high, count, *keys = blobs.unpack(b.as_py(), dtypes)
            found.append([one, two, low.astype(np.int64) + (high.astype(np.int64) << 16),
                          *[np.repeat(k, count) for k in keys]])
    if not found:
        return [np.empty(0, dtype=d) for d in (*dtypes[:2], "<i8", *dtypes[5:])]
    return [np.concatenate(c) for c in zip(*found)]


def _keys(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _level(rows: DataFrame, lengths: list[int], target: int, parts: int, tasks: int) -> DataFrame:
    """``(k1, k2, alive)``: places whose elected run of ``lengths[-1]`` words occurs twice or more.

    ``rows`` has ``k1, k2, text`` and, behind the first level, ``alive``.
    """
    length = lengths[-1]

    def elect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _keys(batch, "k1", "k2")
            column = batch.column("text")
            runs, docs, places = [], [], []
            for lo, hi in slices(column, SLICE_BYTES):
                words = _Words(column.slice(lo, hi - lo), target)
                windows = words.windows
                if len(lengths) > 1:
                    windows = _alive(words, batch.column("alive").slice(lo, hi - lo).to_pylist(), lengths[:-1], target)
                best, every = words.elect(windows, length, target)
                best = np.unique(best)
                runs.append(every[best])
                docs.append(words.row[best] + lo)
                places.append(words.place(best))
            run, doc, place = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (runs, docs, places))
            # A run that repeats inside the batch survives at once; of its entries one joins
            # the others of its hash, twice, and the rest go to any part, in pairs too.
            order = np.argsort(run, kind="stable")
            run, doc, place = run[order], doc[order], place[order]
            again = np.zeros(len(run), dtype=bool)
            if len(run):
                again[1:] = run[1:] == run[:-1]
            settled = again.copy()
            settled[:-1] |= again[1:]
            first = settled & ~again
            part = (run % np.uint64(parts)).astype(np.int32)
            part[again] = (mix(doc[again].astype(np.uint64)) % np.uint64(parts)).astype(np.int32)
            label = run.copy()
            label[again] = mix(run[again] + doc[again].astype(np.uint64))
            twice = np.concatenate([np.arange(len(run)), np.flatnonzero(first | again)])
            hashes = [(label[twice] & np.uint64(0xFFFFFFFF)).astype("<u4"),
                      (label[twice] >> np.uint64(48)).astype("<u2")]
            yield blobs.rows(_send(part[twice], doc[twice].astype(np.int64), hashes, place[twice], keys))

    def survive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, place, k1, k2 = _receive(batches, _LEVEL)
        run = low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))
        order = np.argsort(run, kind="stable")
        same = run[order][1:] == run[order][:-1]
        twice = np.zeros(len(run), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        keep = np.flatnonzero(twice)
        keep = keep[np.lexsort((place[keep], k2[keep], k1[keep]))]
        for lo in range(0, len(keep), 1 << 16):
            i = keep[lo:lo + (1 << 16)]
            yield pa.record_batch([pa.array(k1[i]), pa.array(k2[i]), pa.array(place[i].astype(np.int32))],
                                  names=["k1", "k2", "place"])

    elected = rows.mapInArrow(frugal(elect), blobs.SCHEMA)
    survivors = blobs.exchange(elected, tasks).mapInArrow(frugal(survive), "k1 bigint, k2 bigint, place int")
    return survivors.groupBy("k1", "k2").agg(F.collect_list("place").alias("alive"))    # places of one document


def later_windows(rows: DataFrame, lengths: list[int], target: int, parts: int, tasks: int) -> DataFrame:
    """``(k1, k2, at, n)``: runs of window starts that have an earlier occurrence.

    ``rows``: ``k1, k2, doc_id, text, alive`` of the level below the target.
    """
    below = lengths[-1]

    def open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pc.fill_null(batch.column("doc_id").cast(pa.int64()), int(NO_ID))
            keys = [*_keys(batch, "k1", "k2"), ids.to_numpy(zero_copy_only=False)]
            column = batch.column("text")
            found = []
            for lo, hi in slices(column, SLICE_BYTES):
                words = _Words(column.slice(lo, hi - lo), target)
                windows = _alive(words, batch.column("alive").slice(lo, hi - lo).to_pylist(), lengths, target)
                best, runs = words.elect(windows, below, target)
                one = window_hashes(words.first, target)
                two = window_hashes(words.second, target)
                # the elected run chooses the part: neighbouring windows go together
                found.append((one[windows], two[windows] >> np.uint64(32), words.row[windows] + lo, words.place(windows),
                              mix(runs[best])))
            if not found:
                continue
            one, two, doc, place, where = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((place, keys[0][doc], keys[2][doc], two, one))
            one, two, doc, place, where = (c[order] for c in (one, two, doc, place, where))
            later = _not_first(one, two, keys[2][doc], keys[0][doc], place)
            part = (where % np.uint64(parts)).astype(np.int32)
            # settled windows need no meeting: a hash of their own (zero) and any part
            part[later] = (keys[0][doc[later]].astype(np.uint64) % np.uint64(parts)).astype(np.int32)
            one, two = one.copy(), two.copy()
            one[later] = two[later] = 0
            yield blobs.rows(_send(part, doc, [one, two.astype("<u4")], place, keys))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, place, k1, k2, ids = _receive(batches, _OPEN)
        order = np.lexsort((place, k1, ids, two, one))
        one, two, place, k1, k2, ids = (c[order] for c in (one, two, place, k1, k2, ids))
        later = _not_first(one, two, ids, k1, place) | ((one == 0) & (two == 0))
        k1, k2, place = k1[later], k2[later], place[later].astype(np.int64)
        order = np.lexsort((place, k2, k1))
        k1, k2, place = k1[order], k2[order], place[order]
        fresh = np.ones(len(place), dtype=bool)
        fresh[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (place[1:] > place[:-1] + 1)
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(place)) - 1
        n = place[end] - place[begin] + 1 if len(begin) else begin
        for lo in range(0, len(begin), 1 << 16):
            i = slice(lo, lo + (1 << 16))
            b = begin[i]
            yield pa.record_batch([pa.array(k1[b]), pa.array(k2[b]), pa.array(place[b].astype(np.int32)),
                                   pa.array(n[i].astype(np.int32))], names=["k1", "k2", "at", "n"])

    opened = rows.mapInArrow(frugal(open_windows), blobs.SCHEMA)
    return blobs.exchange(opened, tasks).mapInArrow(frugal(settle), _RUN)


def _not_first(one: np.ndarray, two: np.ndarray, ids: np.ndarray, k1: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of sorted entries: those behind a smaller (id, k1, place) of the same window."""
    later = np.zeros(len(one), dtype=bool)
    if not len(one):
        return later
    new = np.ones(len(one), dtype=bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(one)), 0))
    return (ids != ids[head]) | (k1 != k1[head]) | (place != place[head])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", base: int = BASE,
                   target: int = TARGET, texts: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256; with ``texts`` also kept.

    ``kept`` holds the words that stay, joined by one space.
    """
    ship(docs.sparkSession)
    lengths = [base]
    while lengths[-1] * 2 < target:
        lengths.append(lengths[-1] * 2)
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # one layout for every use, so that the exchange of the texts is made once
    rows = keyed(named, "doc_id", "text").select(
        F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), "doc_id", "text")
    parts = parts_for(named)
    tasks, parts = parts, parts * blobs.PARTS_PER_TASK
    alive = None
    for i in range(len(lengths)):
        source = rows if alive is None else rows.join(alive, ["k1", "k2"])
        columns = ["k1", "k2", "text"] + ([] if alive is None else ["alive"])
        alive = _level(source.select(*columns), lengths[:i + 1], target, parts, tasks)
    last = rows.join(alive, ["k1", "k2"]).select("k1", "k2", "doc_id", "text", "alive")
    runs = later_windows(last, lengths, target, parts, tasks)
    spans = runs.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "n")).alias("spans"))   # of one document
    kind = named.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text"), 2 * SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                n_words, n_removed, digest, kept = [], [], [], []
                for t, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    words = (t or "").encode().split()
                    gone = 0
                    total = len(words)
                    if spans:
                        edge = np.zeros(total + 1, dtype=np.int32)
                        at = np.array([(s["at"], s["at"] + s["n"] - 1 + target) for s in spans])
                        np.add.at(edge, at[:, 0], 1)
                        np.add.at(edge, at[:, 1], -1)
                        stay = np.cumsum(edge[:-1]) == 0
                        gone = int(total - stay.sum())
                        words = compress(words, stay.tolist())
                    out = b" ".join(words)
                    n_words.append(total)
                    n_removed.append(gone)
                    digest.append(hashlib.sha256(out).hexdigest())
                    kept.append(out.decode() if texts else None)
                yield pa.record_batch([part.column("doc_id"), pa.array(n_words, pa.int64()),
                                       pa.array(n_removed, pa.int64()), pa.array(digest, pa.string()),
                                       pa.array(kept, pa.string())],
                                      names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    out = rows.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans").mapInArrow(
        frugal(cut), f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    return out if texts else out.drop("kept")
