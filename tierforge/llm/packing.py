"""Hierarchical multi-length packing of tokenised documents.

Documents go to tiers of context sizes (powers of two up to MAX_LENGTH). A
document's whole windows of MAX_LENGTH stand alone; its remainder opens a
window of the least tier that holds it. Gaps of long windows are filled from
the shorter tiers, the next shorter first, cutting documents freely. What is
left open in the end is merged from both ends, and the last rest of a task is
cut into powers of two, so that no window needs padding.

Each task packs its own rows, in groups of GROUP_TOKENS tokens, so memory does
not grow with the input. Windows of one tier form step groups of STEP_TOKENS
tokens each, equal work for every step.

Defined cases: a null text counts as empty; an empty document is its end token
alone; repeated rows are packed as often as they occur; an empty table gives
an empty table; other columns may be null or bear any name.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierforge.llm.common import frugal, ship
from tierforge.llm.tokens import cut, encoded, forget, letters, slices, spelled, words

MAX_LENGTH = 2048
TIERS = (2048, 1024, 512, 256)
END = 1                          # the id that ends a document
STEP_TOKENS = 16 * MAX_LENGTH    # tokens of a step group
GROUP_TOKENS = 1 << 20           # tokens that are packed together
CACHE_BYTES = 24 << 20           # of one generation of encoded pieces, forgotten when a task ends
SLICE_BYTES = 1 << 18            # text whose words a worker holds at once, some 15 bytes a byte

Piece = tuple[int, int, int]     # document (index in the group), start, length
FIELDS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group")


def plan_windows(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> tuple[list[list[Piece]], list[Piece]]:
    """Full windows (lists of pieces, each adding up to a tier), and pieces that fill none.

    The pieces left over hold fewer than ``tiers[0]`` ids.
    """
    top = tiers[0]
    full: list[list[Piece]] = []
    waiting: dict[int, deque[Piece]] = {t: deque() for t in tiers}
    for d, n in enumerate(lengths):
        whole = n - n % top
        full.extend([(d, s, top)] for s in range(0, whole, top))
        if n > whole:
            least = min(t for t in tiers if t >= n - whole)
            waiting[least].append((d, whole, n - whole))
    rest: list[Piece] = []
    for i, tier in enumerate(tiers):
        shorter = [waiting[t] for t in tiers[i + 1:]]
        while waiting[tier]:
            window = [waiting[tier].popleft()]
            gap = tier - window[0][2]
            for queue in shorter:
                while gap and queue:
                    d, s, n = queue.popleft()
                    window.append((d, s, min(n, gap)))
                    if n > gap:
                        queue.appendleft((d, s + gap, n - gap))
                    gap -= window[-1][2]
            if gap:
                rest.extend(window)
            else:
                full.append(window)
    # open windows: long pieces first, filled up to whole windows from the short end
    rest.sort(key=lambda p: -p[2])
    queue, window, gap = deque(rest), [], top
    while queue:
        d, s, n = queue.popleft() if not window else queue.pop()
        window.append((d, s, min(n, gap)))
        if n > gap:
            queue.append((d, s + gap, n - gap))
        gap -= window[-1][2]
        if not gap:
            full.append(window)
            window, gap = [], top
    return full, window


def binary_windows(pieces: list[Piece]) -> list[list[Piece]]:
    """Windows whose lengths are the powers of two of the pieces' total."""
    total, out = sum(p[2] for p in pieces), []
    queue = deque(pieces)
    for bit in range(total.bit_length() - 1, -1, -1):
        size = 1 << bit
        if not total & size:
            continue
        window = []
        while size:
            d, s, n = queue.popleft()
            window.append((d, s, min(n, size)))
            if n > size:
                queue.appendleft((d, s + size, n - size))
            size -= window[-1][2]
        out.append(window)
    return out


class _Packer:
    """Packs the documents of one task; ``emit`` gives the finished pieces."""

    def __init__(self, base: int) -> None:
        self.next_sequence = base
        self.base = base
        self.made: dict[int, int] = {}
        self.docs: list[tuple[object, bytes]] = []
        self.carried: list[Piece] = []     # what filled no window yet, of the first ``known`` documents
        self.known = 0
        self.tokens = 0

    def add(self, doc_id: object, ids: bytes) -> None:
        self.docs.append((doc_id, ids))
        self.tokens += len(ids) // 4

    def emit(self, last: bool) -> list[list]:
        """Rows of full windows; with ``last`` of all. Unfilled documents stay, in part."""
        spans = self.carried + [(d, 0, len(self.docs[d][1]) // 4) for d in range(self.known, len(self.docs))]
        full, rest = plan_windows([n for _, _, n in spans])
        if last:
            full += binary_windows(rest)
            rest = []
        out = []
        for window in full:
            size = sum(n for _, _, n in window)
            index = self.made.get(size, 0)
            self.made[size] = index + 1
            step = self.base + (index // max(1, STEP_TOKENS // size)) * 16 + size.bit_length()
            offset = 0
            for k, s, n in window:
                d, first, _ = spans[k]
                doc_id, ids = self.docs[d]
                begin = first + s
                out.append([doc_id, begin, n, zlib.crc32(ids[4 * begin:4 * (begin + n)]), len(ids) // 4,
                            self.next_sequence, offset, size, step])
                offset += n
            self.next_sequence += 1
        kept = [spans[k][0] for k, _, _ in rest]
        place = {d: i for i, d in enumerate(dict.fromkeys(kept))}
        self.carried = [(place[spans[k][0]], spans[k][1] + s, n) for k, s, n in rest]
        self.docs = [self.docs[d] for d in place]
        self.known = len(self.docs)
        self.tokens = 0
        return out


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, FIELDS. A map without a shuffle.

    ``sequence_id`` joins the task's number and a counter, so ids are unique
    however many tasks run.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    end = np.array([END], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(TaskContext.get().partitionId() << 32)
        id_type = None
        apart = letters(path) is not None

        def table(found: list[list]) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [()] * (1 + len(FIELDS))
            return pa.record_batch([pa.array(columns[0], id_type), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                                   names=["doc_id", *FIELDS])

        for batch in batches:
            ids, column = batch.column("doc_id"), batch.column("text")
            id_type = ids.type
            for lo, hi in slices(column, SLICE_BYTES):
                names = ids.slice(lo, hi - lo).to_pylist()
                texts = column.slice(lo, hi - lo).to_pylist()
                pieces = [(words(path, t) if apart else cut(t)) if t else [] for t in texts]
                known = encoded(path, pieces, CACHE_BYTES)
                for name, p in zip(names, pieces):
                    packer.add(name, spelled(known, p) + end)
                if packer.tokens >= GROUP_TOKENS:
                    yield table(packer.emit(last=False))
        forget()
        if id_type is not None:
            yield table(packer.emit(last=True))

    return rows.mapInArrow(frugal(run), f"doc_id {kind}, " + ", ".join(f"{f} bigint" for f in FIELDS))
