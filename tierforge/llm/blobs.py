"""Numpy arrays through Spark shuffles: one binary cell holds many fixed-width entries.

A map task deals its entries over numbered parts and sends each part's share
as one row ``(part, blob)``; a task behind the exchange sees the entries of
its parts as arrays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "part int, blob binary"
PARTS_PER_TASK = 4        # parts dealt to one task on average, so that tasks come out even


def pack(columns: Sequence[np.ndarray]) -> bytes:
    head = np.array([len(columns), *[c.nbytes for c in columns]], dtype="<i8")
    return head.tobytes() + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def unpack(blob: bytes, dtypes: Sequence[str]) -> list[np.ndarray]:
    head = np.frombuffer(blob, dtype="<i8", count=len(dtypes) + 1)
    out, at = [], 8 * len(head)
    for size, dtype in zip(head[1:], dtypes):
        out.append(np.frombuffer(blob, dtype=dtype, count=int(size) // np.dtype(dtype).itemsize, offset=at))
        at += int(size)
    return out


def rows(found: Iterable[tuple[int, bytes]]) -> pa.RecordBatch:
    found = list(found)
    return pa.record_batch([pa.array([p for p, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())],
                           names=["part", "blob"])


def deal(part: np.ndarray, columns: Sequence[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Each part that occurs with its share of ``columns``, in their order."""
    if len(part) == 0:
        return
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
        yield int(part[lo]), [c[order[lo:hi]] for c in columns]


def exchange(df: DataFrame, tasks: int) -> DataFrame:
    """Rows of one part to one task."""
    return df.repartition(tasks, "part").select("blob")


def gather(batches: Iterable[pa.RecordBatch], dtypes: Sequence[str]) -> list[np.ndarray]:
    """All entries of this task, column by column."""
    parts = [unpack(b.as_py(), dtypes) for batch in batches for b in batch.column("blob")]
    if not parts:
        return [np.empty(0, dtype=d) for d in dtypes]
    return [np.concatenate(c) for c in zip(*parts)]
