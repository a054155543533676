"""Near-duplicate classes by ProbMinHash.

A text is the multiset of its shingles of WORDS words, weighted by their
counts. Words are runs of letters and digits (any character beyond ASCII
counts as a letter), with A-Z folded to a-z. Every shingle sends arrivals of a Poisson process of its weight to
random registers; a register keeps the shingle that arrives first, and a
shingle stops once its next arrival is later than every register's. Two
texts' registers agree with the probability Jaccard similarity of their
weights. Registers are joined to bands; texts that share a band become
candidates, which are verified on the exact similarity. Linked texts form
classes (connected components).

Copies (equal texts) count as one text. In a band's bucket of at most
ALL_PAIRS texts all pairs are candidates; in a larger one every text is paired
with the bucket's LEADERS and with its CHAIN neighbours in the order of a
longer register key, so candidates stay linear in the rows. A bucket with more
than LOCAL texts inside one batch is thinned to its leaders before the
shuffle, the others being paired with them on the spot. The texts of larger and
of thinned buckets are *open*: a second round gives them FINE_BANDS bands of
FINE_ROWS registers and compares all texts of a bucket that the first round left
in different components, first by a sketch of four bits a register (pairs that
would lie over SLACK standard errors below the similarity go), then exactly.

Defined cases: null and wordless texts are alone; a text of fewer words is one
shingle; classes are named by their smallest ``doc_id`` (null if it has no
other); repeated rows are copies; other columns may be null or bear any name;
an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.llm import blobs
from tierforge.llm.common import fingerprint, frugal, parts_for, ship, spread_join, written
from tierforge.llm.hashing import FOLDED, joined, mix, ranged, text_bytes, window_hashes, word_bounds
from tierforge.llm.tokens import slices

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 32, 4
ARRIVALS = 800            # that a text gets in one round, at least
ALL_PAIRS, LEADERS, CHAIN = 8, 1, 2
LOCAL = 64
FINE_BANDS, FINE_ROWS = 48, 8
SKETCH = 1024             # registers of a sketch; the first ones make the fine bands
SLACK = 3.5
PART_TEXTS = 4096         # open texts for which one part is dealt in the second round
COMPARED_BYTES = 4 << 20  # of sketches that are compared at once, four times as much at the peak
SLICE_BYTES = 1 << 18     # text whose shingles a worker holds at once, some 100 bytes a byte

# band key, longer key, text, thinned bucket | k1, k2 | pairs of texts from thinned buckets
_ENTRY = ("<u8", "<u8", "<u4", "u1", "<i8", "<i8", "<u4", "<u4")
_FINE = ("<u8", "<u4", "<i8", "<i8", "<i8", "u1")             # band key, text | k1, k2, component, sketch
KEY = ("c1", "c2")
LETTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"      # any character of a word


def shingles(column: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, shingle hash, count`` of every distinct shingle, by row."""
    data, starts = text_bytes(column)
    data = FOLDED[data]
    lo, hi, row = word_bounds(data, starts, data > 0)
    units = data.astype(np.uint64) + np.uint64(1)
    word = mix(ranged(units, lo, hi, 0) + (hi - lo).astype(np.uint64))
    runs = window_hashes(word, size) if len(word) >= size else word[:0]
    good = row[:len(runs)] == row[size - 1:size - 1 + len(runs)]
    count = np.bincount(row, minlength=len(column))
    begin = np.concatenate([[0], np.cumsum(count)])
    few = np.flatnonzero((count > 0) & (count < size))
    short = np.array([int(count[r]) for r in few], dtype=np.uint64)
    for k in range(size - 1):
        more = count[few] > k
        short[more] = joined(short[more], word[begin[few[more]] + k])
    rows = np.concatenate([row[:len(runs)][good], few])
    hashes = np.concatenate([runs[good], short])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    head = np.flatnonzero(new)
    return rows[head], hashes[head], np.diff(np.append(head, len(rows)))


def signatures(rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """``texts x registers``: the shingle that arrives first at each register (0 for texts without any)."""
    time = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, dtype=np.uint64)
    count = np.bincount(rows, minlength=texts)
    each = np.maximum(1, -(-ARRIVALS // np.maximum(count, 1)))       # arrivals a shingle gets per round
    row, shingle, weight = rows, hashes, weights.astype(float)
    clock = np.zeros(len(row))
    done = np.zeros(len(row), dtype=np.uint64)
    while len(row):
        many = each[row]
        at = np.repeat(np.arange(len(row)), many)
        begin = np.cumsum(many) - many
        number = done[at] + (np.arange(len(at)) - begin[at]).astype(np.uint64)
        draw = mix(shingle[at] + number * np.uint64(0x9E3779B97F4A7C15))
        wait = -np.log1p(-((draw >> np.uint64(11)).astype(float) * 2.0 ** -53)) / weight[at]
        total = np.cumsum(wait)
        when = total - (total[begin] - wait[begin])[at] + clock[at]
        slot = row[at] * registers + (mix(draw ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(time, slot, when)
        won = time[slot] == when
        winner[slot[won]] = shingle[at[won]]
        clock = when[begin + many - 1]
        done = done + many.astype(np.uint64)
        latest = time.reshape(texts, registers).max(axis=1)
        go = clock < latest[row]                                      # early termination
        row, shingle, weight, clock, done = row[go], shingle[go], weight[go], clock[go], done[go]
    return winner.reshape(texts, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> tuple[np.ndarray, np.ndarray]:
    """``texts x bands`` keys, and keys that take in the next band's registers as well."""
    texts, registers = signature.shape
    per = registers // bands
    block = signature.reshape(texts, bands, per)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (texts, bands)).copy()
    for k in range(per):
        key = joined(key, block[:, :, k])
    return key, joined(key, np.roll(key, -1, axis=1))


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Exact J_P of two weighted sets (sorted distinct hashes ``a, b`` with weights ``x, y``).

    Sum over common i of 1 / sum over j of max(x_j / x_i, y_j / y_i); sorting by
    x / y turns the inner sums into running sums.
    """
    if not len(a) or not len(b):
        return 0.0
    every = np.union1d(a, b)
    wx, wy = np.zeros(len(every)), np.zeros(len(every))
    wx[np.searchsorted(every, a)] = x
    wy[np.searchsorted(every, b)] = y
    both = (wx > 0) & (wy > 0)
    if not both.any():
        return 0.0
    ratio = np.divide(wx, wy, out=np.full(len(every), np.inf), where=wy > 0)
    order = np.argsort(ratio, kind="stable")
    sums_x = np.concatenate([np.cumsum(wx[order][::-1])[::-1], [0.0]])
    sums_y = np.concatenate([[0.0], np.cumsum(wy[order])])
    at = np.searchsorted(ratio[order], ratio[both], "left")
    return float(np.sum(1.0 / (sums_x[at] / wx[both] + sums_y[at] / wy[both])))


def _paired(key: np.ndarray, longer: np.ndarray, text: np.ndarray, rank: np.ndarray,
            thinned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs (of ``text`` numbers) inside the buckets of equal ``key``; entries sorted by (key, longer, rank).

    The third array tells pairs of buckets that are larger than ALL_PAIRS or have a ``thinned`` entry.
    """
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    bucket = np.cumsum(new) - 1
    size = np.bincount(bucket)[bucket] if len(key) else np.empty(0, np.int64)
    loose = size > ALL_PAIRS
    if len(key):
        loose |= (np.bincount(bucket, weights=thinned) > 0)[bucket]
    left, right, open_pair = [], [], []
    for step in range(1, ALL_PAIRS):
        near = np.flatnonzero((bucket[step:] == bucket[:-step]) & ((step <= CHAIN) | (size[:-step] <= ALL_PAIRS)))
        left.append(text[near])
        right.append(text[near + step])
        open_pair.append(loose[near])
    big = np.flatnonzero(size > ALL_PAIRS)
    if len(big):
        # other leaders in every bucket, so that bands don't repeat each other's pairs
        sort = big[np.lexsort((mix(rank[big] ^ key[big]), bucket[big]))]
        first = np.ones(len(sort), dtype=bool)
        first[1:] = bucket[sort][1:] != bucket[sort][:-1]
        head = np.flatnonzero(first)[np.cumsum(first) - 1]
        for k in range(LEADERS):
            left.append(text[sort])
            right.append(text[sort[head + k]])
            open_pair.append(np.ones(len(sort), dtype=bool))
    left, right, open_pair = (np.concatenate(c) for c in (left, right, open_pair))
    differ = left != right
    return left[differ], right[differ], open_pair[differ]


def _sorted_pairs(left: np.ndarray, right: np.ndarray, loose: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every pair once, the smaller number first; ``loose`` if any of its copies is."""
    if not len(left):
        return left, right, loose
    order = np.argsort(~loose, kind="stable")
    pairs, first = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1)[order], axis=0, return_index=True)
    return pairs[:, 0], pairs[:, 1], loose[order][first]


def candidate_pairs(rows: DataFrame, parts: int, tasks: int) -> DataFrame:
    """Distinct ``(a1, a2, b1, b2, loose)``: pairs of texts that meet in a band. ``rows`` has ``c1, c2, text``.

    Both texts of a ``loose`` pair are open.
    """
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in KEY]
            fresh = np.zeros(batch.num_rows, dtype=bool)
            if batch.num_rows:
                fresh[np.unique(np.stack(keys), axis=1, return_index=True)[1]] = True
            found = []
            for lo, hi in slices(batch.column("text"), SLICE_BYTES):
                own = np.flatnonzero(fresh[lo:hi])
                if not len(own):
                    continue
                column = batch.column("text").slice(lo, hi - lo).take(pa.array(own))
                row, hashes, weight = shingles(column)
                some = np.unique(row)
                if not len(some):
                    continue
                signature = signatures(np.searchsorted(some, row), hashes, weight, len(some), BANDS * ROWS)
                key, longer = band_keys(signature)
                found.append((key.ravel(), longer.ravel(), np.repeat(own[some] + lo, BANDS)))
            if not found:
                continue
            key, longer, text = (np.concatenate(c) for c in zip(*found))
            rank = mix(keys[0][text].view(np.uint64))
            order = np.lexsort((rank, longer, key))
            key, longer, text, rank = key[order], longer[order], text[order], rank[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = key[1:] != key[:-1]
            bucket = np.cumsum(new) - 1
            hot = np.bincount(bucket)[bucket] > LOCAL
            here = np.flatnonzero(hot)
            send = ~hot
            left, right = np.empty(0, np.int64), np.empty(0, np.int64)
            if len(here):
                left, right, _ = _sorted_pairs(*_paired(key[here], longer[here], text[here], rank[here], hot[here]))
                sort = here[np.lexsort((rank[here], bucket[here]))]
                begin = np.ones(len(sort), dtype=bool)
                begin[1:] = bucket[sort][1:] != bucket[sort][:-1]
                place = np.arange(len(sort)) - np.flatnonzero(begin)[np.cumsum(begin) - 1]
                send[sort[place < LEADERS]] = True
            key, longer, text, thinned = key[send], longer[send], text[send], hot[send].astype("u1")
            part = np.concatenate([(key % np.uint64(parts)).astype(np.int32),
                                   (mix(left.astype(np.uint64)) % np.uint64(parts)).astype(np.int32)])
            pad = np.zeros(len(left), dtype=np.uint64)
            none = np.full(len(key), -1, dtype=np.int64)
            out = []
            for p, (k, l, t, h, r) in blobs.deal(part, [
                    np.concatenate([key, pad]), np.concatenate([longer, pad]), np.concatenate([text, left]),
                    np.concatenate([thinned, np.zeros(len(left), "u1")]), np.concatenate([none, right])]):
                names, local = np.unique(np.concatenate([t, r[r >= 0]]), return_inverse=True)
                pair = np.flatnonzero(r >= 0)
                entry = np.flatnonzero(r < 0)
                out.append((p, blobs.pack([k[entry], l[entry], local[entry].astype("<u4"), h[entry],
                                           keys[0][names], keys[1][names], local[pair].astype("<u4"), local[len(t):].astype("<u4")])))
            yield blobs.rows(out)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, longers, texts, marks, k1, k2, lefts, rights, base = [], [], [], [], [], [], [], [], 0
        for batch in batches:
            for b in batch.column("blob"):
                key, longer, local, mark, c1, c2, left, right = blobs.unpack(b.as_py(), _ENTRY)
                keys.append(key), longers.append(longer), texts.append(local.astype(np.int64) + base), marks.append(mark)
                lefts.append(left.astype(np.int64) + base), rights.append(right.astype(np.int64) + base)
                k1.append(c1), k2.append(c2)
                base += len(c1)
        if not keys:
            return
        k1, k2 = np.concatenate(k1), np.concatenate(k2)
        both, number = np.unique(np.stack([k1, k2]), axis=1, return_inverse=True)      # copies are one text
        number = number.ravel()
        key, longer, text = np.concatenate(keys), np.concatenate(longers), number[np.concatenate(texts)]
        mark = np.concatenate(marks)
        order = np.lexsort((1 - mark, text, longer, key))                # of repeated entries a marked one stays
        key, longer, text, mark = key[order], longer[order], text[order], mark[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        key, longer, text, mark = key[new], longer[new], text[new], mark[new]
        rank = mix(both[0][text].view(np.uint64))
        left, right, loose = _paired(key, longer, text, rank, mark)
        sent = number[np.concatenate(lefts)], number[np.concatenate(rights)]
        left, right, loose = _sorted_pairs(np.concatenate([left, sent[0]]), np.concatenate([right, sent[1]]),
                                           np.concatenate([loose, np.ones(len(sent[0]), dtype=bool)]))
        for lo in range(0, len(left), 1 << 16):
            a, b, c = (x[lo:lo + (1 << 16)] for x in (left, right, loose))
            yield pa.record_batch([pa.array(both[0][a]), pa.array(both[1][a]), pa.array(both[0][b]), pa.array(both[1][b]),
                                   pa.array(c)], names=["a1", "a2", "b1", "b2", "loose"])

    sketched = rows.select(*KEY, "text").mapInArrow(frugal(sketch), blobs.SCHEMA)
    pairs = blobs.exchange(sketched, tasks).mapInArrow(frugal(meet), "a1 bigint, a2 bigint, b1 bigint, b2 bigint, loose boolean")
    return pairs.groupBy("a1", "a2", "b1", "b2").agg(F.max("loose").alias("loose"))


_AGREE = np.array([(b >> 4 == 0) + (b & 15 == 0) for b in range(256)], dtype=np.uint8)


def sketch_bytes(signature: np.ndarray) -> np.ndarray:
    """``texts x registers / 2`` bytes: four bits of every register."""
    nibble = (mix(signature) & np.uint64(15)).astype(np.uint8)
    return nibble[:, ::2] << np.uint8(4) | nibble[:, 1::2]


def least_agreement(similarity: float, registers: int, slack: float = SLACK) -> int:
    """Equal four-bit registers below which a pair lies over ``slack`` standard errors under ``similarity``."""
    same = similarity + (1 - similarity) / 16
    return int(registers * same - slack * (registers * same * (1 - same)) ** 0.5)


def alike(sketch: np.ndarray, component: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one bucket's texts, of different components, that agree in ``least`` registers; compared in blocks."""
    n, left, right = len(sketch), [], []
    block = max(1, int((COMPARED_BYTES / sketch.shape[1]) ** 0.5))
    for i in range(0, n, block):
        for j in range(i, n, block):
            a, b = np.nonzero(component[i:i + block, None] != component[None, j:j + block])
            a, b = a[a + i < b + j] + i, b[a + i < b + j] + j
            for lo in range(0, len(a), COMPARED_BYTES // sketch.shape[1]):
                x, y = (c[lo:lo + COMPARED_BYTES // sketch.shape[1]] for c in (a, b))
                good = _AGREE[sketch[x] ^ sketch[y]].sum(axis=1, dtype=np.int64) >= least
                left.append(x[good])
                right.append(y[good])
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def fine_pairs(texts: DataFrame, parts: int, tasks: int, similarity: float) -> DataFrame:
    """Distinct ``(a1, a2, b1, b2)`` of open texts (``c1, c2, component, text``) that may link two components."""
    least = least_agreement(similarity, SKETCH)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text"), SLICE_BYTES):
                piece = batch.slice(lo, hi - lo)
                row, hashes, weight = shingles(piece.column("text"))
                some = np.unique(row)
                if not len(some):
                    continue
                k1, k2, component = [piece.column(c).to_numpy(zero_copy_only=False)[some] for c in (*KEY, "component")]
                signature = signatures(np.searchsorted(some, row), hashes, weight, len(some), SKETCH)
                key, marks = band_keys(signature[:, :FINE_BANDS * FINE_ROWS], FINE_BANDS)[0].ravel(), sketch_bytes(signature)
                out = []
                for p, (k, t) in blobs.deal((key % np.uint64(parts)).astype(np.int32),
                                            [key, np.repeat(np.arange(len(some)), FINE_BANDS)]):
                    names, local = np.unique(t, return_inverse=True)
                    out.append((p, blobs.pack([k, local.astype("<u4"), k1[names], k2[names], component[names], marks[names]])))
                yield blobs.rows(out)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, base = [], 0
        for batch in batches:
            for b in batch.column("blob"):
                key, local, *about = blobs.unpack(b.as_py(), _FINE)
                found.append((key, local.astype(np.int64) + base, *about))
                base += len(about[0])
        if not found:
            return
        key, text, k1, k2, component, marks = (np.concatenate(c) for c in zip(*found))
        marks = marks.reshape(-1, SKETCH // 2)
        order = np.argsort(key, kind="stable")
        key, text = key[order], text[order]
        cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            own = text[lo:hi]
            if hi - lo > 1 and (component[own] != component[own[0]]).any():
                a, b = alike(marks[own], component[own], least)
                left.append(own[a])
                right.append(own[b])
        left, right = np.concatenate(left), np.concatenate(right)
        # a text has another number in every blob: pairs are told apart by their keys
        swap = (k1[left] > k1[right]) | ((k1[left] == k1[right]) & (k2[left] > k2[right]))
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        pairs = np.unique(np.stack([k1[left], k2[left], k1[right], k2[right]], axis=1), axis=0)
        for lo in range(0, len(pairs), 1 << 16):
            yield pa.record_batch([pa.array(c) for c in pairs[lo:lo + (1 << 16)].T.copy()], names=["a1", "a2", "b1", "b2"])

    sketched = texts.select(*KEY, "component", "text").mapInArrow(frugal(sketch), blobs.SCHEMA)
    return blobs.exchange(sketched, tasks).mapInArrow(frugal(compare), "a1 bigint, a2 bigint, b1 bigint, b2 bigint").distinct()


def named_texts(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(c1, c2, text)``: one row per content that is in a pair."""
    named = pairs.select(F.col("a1").alias("c1"), F.col("a2").alias("c2")).unionByName(
        pairs.select(F.col("b1").alias("c1"), F.col("b2").alias("c2"))).distinct()
    # one text per content: copies are dropped by a map-side aggregation of the keys' rows
    return rows.select(*KEY, "text").join(named, list(KEY), "left_semi").dropDuplicates(list(KEY))


def verified_links(texts: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(a1, a2, b1, b2, similarity)`` of the pairs of ``texts`` that reach ``similarity``."""
    left = pairs.join(texts.select(F.col("c1").alias("a1"), F.col("c2").alias("a2"), F.col("text").alias("a")), ["a1", "a2"])
    full = left.join(texts.select(F.col("c1").alias("b1"), F.col("c2").alias("b2"), F.col("text").alias("b")), ["b1", "b2"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("a"), SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                sides = []
                for name in ("a", "b"):
                    row, hashes, weight = shingles(part.column(name))
                    cuts = np.searchsorted(row, np.arange(hi - lo + 1))
                    sides.append((hashes, weight, cuts))
                (ha, wa, ca), (hb, wb, cb) = sides
                found = np.array([probability_jaccard(ha[ca[i]:ca[i + 1]], wa[ca[i]:ca[i + 1]],
                                                      hb[cb[i]:cb[i + 1]], wb[cb[i]:cb[i + 1]]) for i in range(hi - lo)])
                keep = np.flatnonzero(found >= similarity - 1e-9)
                kept = part.select(["a1", "a2", "b1", "b2"]).take(pa.array(keep))
                yield pa.record_batch([*kept.columns, pa.array(found[keep])], names=["a1", "a2", "b1", "b2", "similarity"])

    return full.select("a1", "a2", "b1", "b2", "a", "b").mapInArrow(
        frugal(verify), "a1 bigint, a2 bigint, b1 bigint, b2 bigint, similarity double")


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` of a written table of links ``(a, b)``: the least node of each component.

    Every round takes the least label among the neighbours and then the label's
    own label; written tables between rounds keep plans short and survive lost
    executors. Labels fall by whole neighbourhoods, so rounds grow with the
    logarithm of a component's width.
    """
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = written(edges, "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        lower = written(lower, "labels")
        jumped = lower.select(F.col("node").alias("label"), F.col("label").alias("above"))
        fresh = written(lower.join(jumped, "label", "left").select(
            "node", F.least(F.col("label"), F.coalesce("above", "label")).alias("label"), "was"), "labels")
        changed = fresh.where(F.col("label") != F.col("was")).limit(1).count()
        labels = fresh.select("node", "label")
        if not changed:
            return labels


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``carry`` columns, doc_id, class_id, class_size, n_verified_links, kept (the class's smallest id).

    ``n_verified_links`` counts the candidate pairs of the row's text that were
    verified. In buckets of more than ALL_PAIRS texts not all pairs are
    candidates, so it is no count of all similar texts.
    """
    ship(docs.sparkSession)
    c1, c2 = fingerprint(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(*carry, F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       c1.alias("c1"), c2.alias("c2"))
    parts = parts_for(rows)
    pairs = written(candidate_pairs(rows, parts * blobs.PARTS_PER_TASK, parts), "near-pairs")
    met = pairs.where("loose")
    open_texts = met.select(F.col("a1").alias("c1"), F.col("a2").alias("c2")).unionByName(
        met.select(F.col("b1").alias("c1"), F.col("b2").alias("c2"))).distinct()
    contents = written(named_texts(rows, pairs), "near-texts")

    def linked(pairs: DataFrame, label: str) -> DataFrame:
        return written(verified_links(contents, pairs, similarity).select(
            F.struct(F.col("a1").alias("c1"), F.col("a2").alias("c2")).alias("a"),
            F.struct(F.col("b1").alias("c1"), F.col("b2").alias("c2")).alias("b")), label)

    links = linked(pairs, "near-links")
    labels = components(links).select("node.*", "label")
    loose = written(open_texts.join(labels, list(KEY), "left").select(
        *KEY, F.coalesce("label", F.struct(*KEY)).alias("label")), "near-open")
    count = loose.count()                                       # of Parquet footers
    if count:
        fine_parts = math.ceil(count / PART_TEXTS)
        sides = contents.join(loose.withColumn("component", F.xxhash64("label")), list(KEY))
        fine = written(fine_pairs(sides, fine_parts, max(parts, fine_parts), similarity), "near-fine-pairs")
        more = linked(fine, "near-fine-links")
        # links between components: joined over the components' names
        name = [loose.select(F.struct(*KEY).alias(side), F.col("label").alias(f"of_{side}")) for side in ("a", "b")]
        between = components(written(more.join(name[0], "a").join(name[1], "b").select(
            F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct(), "near-between"))
        grown = (labels.select(F.struct(*KEY).alias("member"), "label")
                 .unionByName(loose.select(F.struct(*KEY).alias("member"), "label")).distinct())
        labels = grown.join(between.select(F.col("node").alias("label"), F.col("label").alias("joined")), "label", "left").select(
            "member.*", F.coalesce("joined", "label").alias("label"))
        links = links.unionByName(more)
    degree = links.select(F.explode(F.array("a", "b")).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("n_verified_links"))
    texts = rows.groupBy(*KEY).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"),
                                   F.max(F.col("text").rlike(LETTER)).alias("worded"))
    texts = (texts.join(labels, list(KEY), "left").join(degree.select("n.c1", "n.c2", "n_verified_links"), list(KEY), "left")
                  .withColumn("label", F.coalesce("label", F.struct(*KEY))))
    texts = written(texts, "near-texts-classes")
    classes = texts.groupBy("label").agg(F.min("first").alias("class_id"), F.sum("n").alias("class_size"))
    named = texts.join(classes, "label").select(*KEY, "class_id", "class_size", "n_verified_links", "worded")
    alone = ~F.col("worded")
    return spread_join(rows.select(*carry, "doc_id", *KEY), named, KEY).select(
        *carry, "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("bigint").alias("class_size"),
        F.coalesce("n_verified_links", F.lit(0)).cast("bigint").alias("n_verified_links"),
        (alone | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))
