"""Repeated byte strings by suffix arrays over shards, merged across shards.

Goal: every byte covered by a ``target``-byte string that also starts anywhere
else, in the same document or another; matches stay inside one document.

1. Every window of ``target`` bytes elects its least-hashed GRAM bytes, its
   anchor; neighbouring windows with one anchor form a region. Equal windows
   have equal anchors. Regions meet by their anchor: a lone anchor ends the
   search, equal regions (128-bit fingerprints of their bytes) are settled,
   and only regions that share an anchor but differ go on, with their bytes;
   of these only such as share a side too. Equal windows have the same bytes
   around the anchor, at least half of ``target - GRAM`` on one of its sides, so
   128 bytes there must be equal.
2. Regions are dealt to shards, all of one anchor to the same shard. A shard
   of at most SHARD_BYTES builds a suffix array by Larsson-Sadakane refinement
   (ranks of doubled length, unsorted groups only) and common prefixes by
   Kasai's rule. Neighbours in suffix order that share ``target`` bytes repeat.
3. Anchors with more than HOT_REGIONS different regions are dealt over many
   shards. Each such shard sends a sorted list of its remaining windows'
   fingerprints, and a merge finds those of other shards by binary search.

Copies inside a batch are settled before the shuffle and send one region.

Defined cases: a null text counts as empty; shorter texts keep all; rows that
repeat id and text are two documents with equal texts; other columns may be
null or bear any name; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.llm import blobs
from tierforge.llm.common import frugal, keyed, parts_for, ship
from tierforge.llm.hashing import joined, mix, ranged, text_bytes
from tierforge.llm.tokens import slices

TARGET, GRAM = 400, 128
SLICE_BYTES = 1 << 20
SHARD_BYTES = 2 << 20
HOT_REGIONS = 2048
_PLACE_BITS = 22              # a slice, or a segment of a long row, is shorter than this many bits

SETTLED, UNKNOWN, KNOWN = 0, 1, 2       # regions: repeated; to be searched; to be searched in
HOT = 4

_REGION = ("<u8", "<u8", "<u8", "<u8", "<u8", "u1", "<u4", "<u4", "<u4", "<i8", "<i8")  # anchor, sides, print (2), state, document, at, n | k1, k2
_BYTES = ("<u8", "u1", "<u4", "<u4", "<u4", "<i8", "<i8", "u1")            # anchor, kind, document, at, n | k1, k2 | bytes
_PRINT = ("<u8", "<u8", "u1", "<u4", "<u4", "<u4", "<i8", "<i8")           # print (2), kind, document, at, n | k1, k2
_RUN = "k1 bigint, k2 bigint, at bigint, n bigint"


def _eights(data: np.ndarray, order: str) -> np.ndarray:
    """Eight bytes from every position on, zeros behind the end."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(15, dtype=np.uint8)])
    out = np.empty(n, dtype=np.uint64)
    for k in range(min(8, n)):
        size = len(out[k::8])
        out[k::8] = padded[k:k + 8 * size].view(f"{order}u8")
    return out


def _grams(data: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of ``length`` bytes (a power of two, 16 at least) from every position."""
    h = _eights(data, "<") ^ np.uint64(salt)
    step = 8
    while step < length:
        h = joined(h[:-step], h[step:]) if len(h) > step else h[:0]
        step *= 2
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by block prefixes and suffixes."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:len(values)] = values
    block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _stretches(column: pa.Array, target: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """``bytes, row starts, first row, offset in it``: slices of rows, long rows in overlapping segments."""
    most = 1 << (_PLACE_BITS - 1)
    for lo, hi in slices(column, SLICE_BYTES):
        data, starts = text_bytes(column.slice(lo, hi - lo))
        if len(data) <= most:
            yield data, starts, lo, 0
            continue
        for r in range(hi - lo):              # one long row, as slices() goes
            row = data[starts[r]:starts[r + 1]]
            for a in range(0, max(1, len(row) - target + 1), most - target):
                part = row[a:a + most - 1]
                yield part, np.array([0, len(part)]), lo + r, a


def gram_and_side(target: int) -> tuple[int, int]:
    """Bytes of an anchor and of what must be equal beside it: powers of two, for windows of ``target`` bytes.

    Small targets leave no room for a side (0): then every side counts as equal.
    """
    gram = GRAM
    while gram > 16 and 3 * gram > target:
        gram //= 2
    side = 16
    while 2 * side <= (target - gram + 1) // 2:
        side *= 2
    return gram, side if 2 * side <= target - gram + 1 else 0


def _regions(data: np.ndarray, starts: np.ndarray, target: int) -> tuple[np.ndarray, ...]:
    """``row, at, n, anchor, left, right, print, print`` of every region; ``at`` counts from the row's first byte.

    ``left`` and ``right`` hash the ``side`` bytes before and behind the anchor,
    0 if the row (or the segment of a long one) has not so many there.
    """
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 5
    if len(data) < target:
        return none
    edge = np.zeros(len(data) + 1, dtype=np.int32)
    long = np.flatnonzero(np.diff(starts) >= target)
    if not len(long):
        return none
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, starts[long + 1] - target + 1, -1)
    windows = np.flatnonzero(np.cumsum(edge[:-1]))
    gram_bytes, side = gram_and_side(target)
    gram = _grams(data, gram_bytes)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = _sliding_min((gram & ~low) | np.arange(len(gram), dtype=np.uint64), target - gram_bytes + 1)
    elected = (least[windows] & low).astype(np.int64)
    fresh = np.ones(len(windows), dtype=bool)
    fresh[1:] = (np.diff(windows) > 1) | (np.diff(elected) != 0)
    begin = np.flatnonzero(fresh)
    lo = windows[begin]
    hi = windows[np.append(begin[1:], len(windows)) - 1]
    n = hi - lo + 1
    row = np.searchsorted(starts, lo, "right") - 1
    short = _grams(data, 16)
    size = n.astype(np.uint64)
    one = mix(ranged(mix(short), lo, hi + target - 15, 0) + size)
    two = mix(ranged(mix(short ^ np.uint64(0x5851F42D4C957F2D)), lo, hi + target - 15, 1) ^ size)
    anchor = elected[begin]
    left = right = np.ones(len(row), dtype=np.uint64)
    if side:
        beside = gram if side == gram_bytes else _grams(data, side)
        before, behind = anchor - side, anchor + gram_bytes
        left, right = (np.where(inside, beside[np.clip(at, 0, len(beside) - 1)] | np.uint64(1), np.uint64(0)) for at, inside in (
            (before, before >= starts[row]), (behind, behind + side <= starts[row + 1])))
    return row, lo - starts[row], n, gram[anchor], left, right, one, two


def suffix_order(data: np.ndarray, end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array (ordered by ``depth`` bytes at least), and the first eight bytes of each suffix.

    ``end[i]`` is where position ``i``'s own region ends; suffixes stop there.
    Larsson-Sadakane: ranks by ``h`` bytes give ranks by ``2h``; groups of one
    are done and never looked at again.
    """
    n = len(data)
    spare = np.uint64(8) * (np.uint64(8) - np.minimum(end - np.arange(n), 8).astype(np.uint64))
    first = _eights(data, ">") >> spare << spare
    order = np.argsort(first, kind="stable")
    head = np.ones(n, dtype=bool)
    head[1:] = first[order][1:] != first[order][:-1]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    h = 8
    while h < depth:
        alone = head.copy()
        alone[:-1] &= head[1:]
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        at = order[slots]
        ahead = at + h
        following = np.where(ahead < end[at], rank[np.minimum(ahead, n - 1)], -1)
        sort = np.lexsort((following, rank[at]))
        at, following = at[sort], following[sort]
        group = rank[at]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (following[1:] != following[:-1])
        order[slots] = at
        head[slots] = new
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        h *= 2
    return order, first


def _common(i: np.ndarray, j: np.ndarray, end: np.ndarray, first: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes ``i`` and ``j``, eight bytes at a time."""
    out = np.zeros(len(i), dtype=np.int64)
    room = np.minimum(end[i] - i, end[j] - j)
    todo = np.arange(len(i))
    while len(todo):
        a, b = i[todo] + out[todo], j[todo] + out[todo]
        left = room[todo] - out[todo]
        inside = left >= 8
        same = np.zeros(len(todo), dtype=bool)
        same[inside] = first[a[inside]] == first[b[inside]]
        tail = todo[~same]
        for _ in range(8):
            more = out[tail] < room[tail]
            tail = tail[more]
            equal = data[i[tail] + out[tail]] == data[j[tail] + out[tail]]
            tail = tail[equal]
            out[tail] += 1
        todo = todo[same]
        out[todo] += 8
    return out


def common_prefixes(order: np.ndarray, first: np.ndarray, end: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it (0 for the first).

    Kasai's rule: if position ``i`` follows ``j`` in the order, shares ``l > 0``
    bytes with it, and ``i + 1`` follows ``j + 1``, these share ``l - 1``. Only
    where the rule does not apply are bytes compared.
    """
    n = len(order)
    if n == 0:
        return np.empty(0, dtype=np.int64)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    direct = np.ones(n, dtype=bool)
    direct[1:] = (before[1:] != before[:-1] + 1) | (before[:-1] < 0) | (end[1:] != end[:-1])
    inner = ~direct
    inner[inner] = end[before[inner]] == end[before[inner] - 1]
    direct = ~inner
    shared = np.zeros(n, dtype=np.int64)

    def compare(which: np.ndarray) -> None:
        which = which[before[which] >= 0]
        shared[which] = _common(which, before[which], end, first, data)

    compare(np.flatnonzero(direct))
    root = np.maximum.accumulate(np.where(direct, place, 0))
    shared = np.where(direct, shared, shared[root] - (place - root))
    compare(np.flatnonzero(shared < 0))
    return shared[order]


def repeated_classes(data: np.ndarray, end: np.ndarray, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose ``target`` bytes occur at another position too, and their class numbers."""
    order, first = suffix_order(data, end, target)
    shared = common_prefixes(order, first, end, data)
    label = np.cumsum(shared < target)
    twice = np.bincount(label)[label] > 1
    return order[twice], label[twice]


def _named(doc: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    names, local = np.unique(doc, return_inverse=True)
    return local.astype("<u4"), [k[names] for k in keys]


def _met(group: np.ndarray, side: np.ndarray, new: np.ndarray, settled: np.ndarray) -> np.ndarray:
    """Different regions (``new``) that share group and side with another one, if one of them is not settled."""
    out = np.zeros(len(group), dtype=bool)
    which = np.flatnonzero(new & (side != 0))
    if len(which):
        which = which[np.lexsort((side[which], group[which]))]
        begin = np.ones(len(which), dtype=bool)
        begin[1:] = (group[which][1:] != group[which][:-1]) | (side[which][1:] != side[which][:-1])
        cell = np.cumsum(begin) - 1
        out[which] = (np.bincount(cell)[cell] > 1) & (np.bincount(cell, weights=~settled[which])[cell] > 0)
    return out


def _anchors(rows: DataFrame, target: int, parts: int, tasks: int, hot_regions: int) -> DataFrame:
    """``(k1, k2, at, n, kind, anchor)``: settled regions, and those whose bytes must be searched."""
    def elect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("k1", "k2")]
            found = []
            for data, starts, row, offset in _stretches(batch.column("text"), target):
                r, at, *hashes = _regions(data, starts, target)
                found.append((r + row, at + offset, *hashes))
            if not found:
                continue
            doc, at, n, anchor, left, right, one, two = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((two, one))
            doc, at, n, anchor, left, right, one, two = (c[order] for c in (doc, at, n, anchor, left, right, one, two))
            again = np.zeros(len(doc), dtype=bool)
            again[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
            state = again.astype(np.uint8) * 2                  # 2: settled here, 1: stands for copies, 0: seen once
            state[:-1][again[1:] & ~again[:-1]] = 1
            part = (anchor % np.uint64(parts)).astype(np.int32)
            part[again] = (mix(doc[again].astype(np.uint64)) % np.uint64(parts)).astype(np.int32)
            back = np.lexsort((at, doc))
            out = []
            for p, (d, *share) in blobs.deal(part[back], [c[back] for c in (doc, anchor, left, right, one, two, state, at, n)]):
                local, named = _named(d, keys)
                *hashes, s, begin, size = share
                out.append((p, blobs.pack([*hashes, s, local, begin.astype("<u4"), size.astype("<u4"), *named])))
            yield blobs.rows(out)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for b in batch.column("blob"):
                c = blobs.unpack(b.as_py(), _REGION)
                found.append((*c[:6], c[7], c[8], c[9][c[6]], c[10][c[6]]))
        if not found:
            return
        anchor, left, right, one, two, state, at, n, k1, k2 = (np.concatenate(c) for c in zip(*found))
        kind = np.full(len(anchor), 255, dtype=np.uint8)
        kind[state == 2] = SETTLED
        here = np.flatnonzero(state != 2)
        here = here[np.lexsort((two[here], one[here], anchor[here]))]
        a, f, g = anchor[here], one[here], two[here]
        new_anchor = np.ones(len(here), dtype=bool)
        new_anchor[1:] = a[1:] != a[:-1]
        new_print = new_anchor.copy()
        new_print[1:] |= (f[1:] != f[:-1]) | (g[1:] != g[:-1])
        group, region = np.cumsum(new_anchor) - 1, np.cumsum(new_print) - 1
        if len(here):
            copies = np.bincount(region, weights=1 + (state[here] == 1))
            settled = copies[region] > 1
            different = np.bincount(group[new_print])[group]
            search = np.zeros(len(here), dtype=bool)
            for side in (left[here], right[here]):
                search |= _met(group, side, new_print, settled)
            hot = HOT * (different > hot_regions).astype(np.uint8)
            result = np.where(settled, SETTLED, 255).astype(np.uint8)
            lone = search & ~settled
            result[lone] = UNKNOWN + hot[lone]
            kind[here] = result
            extra = here[search & settled]
            extra_kind = (KNOWN + hot[search & settled]).astype(np.uint8)
        else:
            extra, extra_kind = here, np.empty(0, np.uint8)
        keep = np.flatnonzero(kind != 255)
        rows_ = np.concatenate([keep, extra])
        kinds = np.concatenate([kind[keep], extra_kind])
        sort = np.lexsort((at[rows_], k2[rows_], k1[rows_]))
        rows_, kinds = rows_[sort], kinds[sort]
        for lo in range(0, len(rows_), 1 << 16):
            i = rows_[lo:lo + (1 << 16)]
            yield pa.record_batch(
                [pa.array(k1[i]), pa.array(k2[i]), pa.array(at[i].astype(np.int64)), pa.array(n[i].astype(np.int64)),
                 pa.array(kinds[lo:lo + (1 << 16)].astype(np.int32)), pa.array(anchor[i].view(np.int64))],
                names=["k1", "k2", "at", "n", "kind", "anchor"])

    elected = rows.select("k1", "k2", "text").mapInArrow(frugal(elect), blobs.SCHEMA)
    met = blobs.exchange(elected, tasks).mapInArrow(frugal(meet), _RUN + ", kind int, anchor bigint")
    return met.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "n", "kind", "anchor")).alias("regions"))


def _search(rows: DataFrame, target: int, parts: int, tasks: int, shard_bytes: int) -> DataFrame:
    """``(k1, k2, at, n)``: runs of repeated window starts. ``rows``: ``k1, k2, doc_id, text, regions``."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("k1", "k2")]
            lists, text = batch.column("regions"), batch.column("text")
            out: list[tuple[int, bytes]] = []
            for lo, hi in slices(text, 8 * SLICE_BYTES):
                data, starts = text_bytes(text.slice(lo, hi - lo))
                own = lists.slice(lo, hi - lo)
                flat = own.flatten()
                at, n, kind, anchor = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                doc = np.repeat(np.arange(hi - lo), own.value_lengths().to_numpy(zero_copy_only=False))
                anchor = anchor.view(np.uint64)
                where = anchor + np.where(kind >= HOT, mix(doc.astype(np.uint64) + keys[0][lo + doc].view(np.uint64)), 0
                                          ).astype(np.uint64)
                where = np.where(kind == SETTLED, keys[0][lo + doc].view(np.uint64), where)
                part = (mix(where) % np.uint64(parts)).astype(np.int32)
                for p, (d, a, k, begin, size) in blobs.deal(part, [doc, anchor, kind, at, n]):
                    local, named = _named(d + lo, keys)
                    begins = starts[d] + begin
                    body = [data[b:b + m + target - 1] for b, m, x in zip(begins.tolist(), size.tolist(), k.tolist())
                            if x != SETTLED]
                    out.append((p, blobs.pack([a, k.astype("u1"), local, begin.astype("<u4"), size.astype("<u4"), *named,
                                               np.concatenate(body) if body else np.empty(0, np.uint8)])))
            yield blobs.rows(out)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[tuple[np.ndarray, ...]] = []          # settled: k1, k2, at, n
        regions: list[tuple] = []
        bodies: list[np.ndarray] = []
        for batch in batches:
            for b in batch.column("blob"):
                a, kind, local, at, n, k1, k2, body = blobs.unpack(b.as_py(), _BYTES)
                done = kind == SETTLED
                runs.append((k1[local[done]], k2[local[done]], at[done].astype(np.int64), n[done].astype(np.int64)))
                todo = np.flatnonzero(~done)
                ends = np.cumsum(n[todo].astype(np.int64) + target - 1)
                regions.append((a[todo], kind[todo], k1[local[todo]], k2[local[todo]], at[todo].astype(np.int64),
                                n[todo].astype(np.int64)))
                bodies.extend(np.split(body, ends[:-1]) if len(todo) else [])
        opened: list[tuple[np.ndarray, ...]] = []        # hot windows: print, print, kind, k1, k2, at
        if bodies:
            anchor, kind, k1, k2, at, n = (np.concatenate(c) for c in zip(*regions))
            order = np.lexsort((anchor, kind >= HOT))
            size = np.cumsum((n + target - 1)[order])
            apart = np.ones(len(order), dtype=bool)      # hot regions, and a new anchor, may begin a shard
            apart[1:] = (anchor[order][1:] != anchor[order][:-1]) | (kind[order][1:] >= HOT)
            lo, base = 0, 0
            for i in [*np.flatnonzero(apart)[1:].tolist(), len(order)]:
                if i < len(order) and size[i - 1] - base < shard_bytes:
                    continue
                chosen = order[lo:i]
                settled, prints = _shard([bodies[c] for c in chosen], kind[chosen], n[chosen], target)
                place, count = settled
                region = chosen[place[0]]
                runs.append((k1[region], k2[region], at[region] + place[1], count))
                r = chosen[prints[3]]
                opened.append((*prints[:3], k1[r], k2[r], at[r] + prints[4]))
                lo, base = i, size[i - 1]
        yield _merged_blobs(runs, opened)

    def _merged_blobs(runs: list, opened: list) -> pa.RecordBatch:
        out = []
        if runs:
            k1, k2, at, n = (np.concatenate(c) for c in zip(*runs))
            zero = np.zeros(len(k1), dtype=np.uint64)
            _pack(out, (k1.view(np.uint64) % np.uint64(parts)).astype(np.int32), zero, zero,
                  np.zeros(len(k1), np.uint8), at, n, k1, k2)
        if opened:
            one, two, kind, k1, k2, at = (np.concatenate(c) for c in zip(*opened))
            sort = np.lexsort((two, one))
            one, two, kind, k1, k2, at = (c[sort] for c in (one, two, kind, k1, k2, at))
            _pack(out, (one % np.uint64(parts)).astype(np.int32), one, two, kind, at, np.ones(len(at), np.int64), k1, k2)
        return blobs.rows(out)

    def _pack(out: list, part: np.ndarray, one, two, kind, at, n, k1, k2) -> None:
        for p, (f, g, k, begin, size, a, b) in blobs.deal(part, [one, two, kind, at, n, k1, k2]):
            pairs, local = np.unique(np.stack([a, b]), axis=1, return_inverse=True)
            out.append((p, blobs.pack([f, g, k, local.ravel().astype("<u4"), begin.astype("<u4"), size.astype("<u4"),
                                       pairs[0], pairs[1]])))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = []
        for batch in batches:
            for b in batch.column("blob"):
                f, g, k, local, at, n, k1, k2 = blobs.unpack(b.as_py(), _PRINT)
                lists.append((f, g, k, at.astype(np.int64), n.astype(np.int64), k1[local], k2[local]))
        if not lists:
            return
        every = np.sort(np.concatenate([f[k != SETTLED] for f, _, k, *_ in lists]))
        kept = []
        for f, g, k, at, n, k1, k2 in lists:
            # each shard's list is sorted: its prints are found in the merged order by binary search
            many = np.searchsorted(every, f, "right") - np.searchsorted(every, f, "left") > 1
            kept.append((k == SETTLED) | many)
        f, g, k, at, n, k1, k2 = (np.concatenate([c[m] for c, m in zip(col, kept)]) for col in zip(*lists))
        order = np.lexsort((g, f))
        same = (f[order][1:] == f[order][:-1]) & (g[order][1:] == g[order][:-1])     # the whole 128 bits
        twice = np.zeros(len(f), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        final = np.flatnonzero((k == SETTLED) | (twice & (k % HOT == UNKNOWN)))
        final = final[np.lexsort((at[final], k2[final], k1[final]))]
        for lo in range(0, len(final), 1 << 16):
            i = final[lo:lo + (1 << 16)]
            yield pa.record_batch([pa.array(k1[i]), pa.array(k2[i]), pa.array(at[i]), pa.array(n[i])],
                                  names=["k1", "k2", "at", "n"])

    sent = rows.mapInArrow(frugal(send), blobs.SCHEMA)
    searched = blobs.exchange(sent, tasks).mapInArrow(frugal(shards), blobs.SCHEMA)
    return blobs.exchange(searched, tasks).mapInArrow(frugal(merge), _RUN)


def _shard(bodies: list[np.ndarray], kind: np.ndarray, n: np.ndarray, target: int):
    """Of one shard: runs of repeated windows ``((region, start), count)``, and hot windows still open.

    The open ones: ``print, print, kind, region, start``; a window that repeats
    inside the shard is sent once, for the other shards.
    """
    sizes = np.array([len(b) for b in bodies])
    data = np.concatenate(bodies)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    region = np.repeat(np.arange(len(bodies)), sizes)
    end = begin[1:][region]
    at, label = repeated_classes(data, end, target)
    twice = np.zeros(len(data), dtype=bool)
    twice[at] = True
    wanted = kind % HOT == UNKNOWN
    found = np.flatnonzero(twice & wanted[region])
    fresh = np.ones(len(found), dtype=bool)
    fresh[1:] = (np.diff(found) > 1) | (np.diff(region[found]) > 0)
    head = np.flatnonzero(fresh)
    count = np.diff(np.append(head, len(found)))
    runs = ((region[found[head]], found[head] - begin[region[found[head]]]), count)
    hot = kind >= HOT
    none = (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.uint8), np.empty(0, np.int64),
            np.empty(0, np.int64))
    if not hot.any():
        return runs, none
    start = np.arange(len(data)) - begin[region] < n[region]
    first_of = np.zeros(len(data), dtype=bool)
    first_of[at[np.unique(label, return_index=True)[1]]] = True
    windows = np.flatnonzero(start & hot[region] & (~twice | first_of))
    prints = [_long(data, target, salt)[windows] for salt in (0, 0x2545F4914F6CDD1D)]
    state = np.where(twice[windows], HOT + KNOWN, kind[region[windows]]).astype(np.uint8)
    return runs, (*prints, state, region[windows], windows - begin[region[windows]])


def _long(data: np.ndarray, target: int, salt: int) -> np.ndarray:
    """Hash of ``target`` bytes from every position: two overlapping powers of two."""
    size = 1 << (target.bit_length() - 1)
    h = _grams(data, size, salt)
    return joined(h[:len(h) - (target - size)], h[target - size:])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", target: int = TARGET,
                   hot_regions: int = HOT_REGIONS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed byte ranges)."""
    ship(docs.sparkSession)
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = keyed(named, "doc_id", "text").select(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), "doc_id", "text")
    parts = parts_for(named)
    tasks, parts = parts, parts * blobs.PARTS_PER_TASK
    regions = _anchors(rows, target, parts, tasks, hot_regions)
    # the columns of the last join, so that one exchange of the texts serves both
    source = rows.join(regions, ["k1", "k2"]).select("k1", "k2", "doc_id", "text", "regions")
    runs = _search(source, target, parts, tasks, shard_bytes)
    found = runs.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "n")).alias("runs"))     # of one document
    kind = named.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for lo, hi in slices(column, 4 * SLICE_BYTES):
                data, starts = text_bytes(column.slice(lo, hi - lo))
                own = batch.column("runs").slice(lo, hi - lo)
                removed, spans, digest = [], [], []
                for r, lists in enumerate(own):
                    body = data[starts[r]:starts[r + 1]]
                    ranges: list[dict[str, int]] = []
                    if lists.is_valid:
                        edge = np.zeros(len(body) + 1, dtype=np.int32)
                        at, n = (lists.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + n - 1 + target, -1)
                        gone = np.cumsum(edge[:-1]) > 0
                        turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                        ranges = [{"start": a, "end": b} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist())]
                        body = body[~gone]
                    spans.append(ranges)
                    removed.append(sum(x["end"] - x["start"] for x in ranges))
                    digest.append(hashlib.sha256(body.tobytes()).hexdigest())
                yield pa.record_batch(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(starts)), pa.array(removed, pa.int64()),
                     pa.array([len(s) for s in spans], pa.int64()), pa.array(digest, pa.string()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return rows.join(found, ["k1", "k2"], "left").select("doc_id", "text", "runs").mapInArrow(
        frugal(cut), f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
             "spans array<struct<start:bigint,end:bigint>>")
