"""Vectorised hashing of bytes, words and windows (64-bit, wrapping)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)        # odd, so that powers can be undone
KEPT_POWERS = 1 << 19                                   # 4 MB each of four bases
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hashes of its two halves."""
    return mix(left * np.uint64(BASES[0]) + (right ^ np.uint64(BASES[1])))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)``; up to KEPT_POWERS of them are kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if len(have) <= KEPT_POWERS:
            _POWERS[base] = have
    return have[:n]


def ranged(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, which: int) -> np.ndarray:
    """Position-independent polynomial hash of ``values[lo:hi]`` for many ranges."""
    base = BASES[which]
    inverse = pow(base, -1, 1 << 64)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    return (sums[hi] - sums[lo]) * powers(inverse, len(values) + 1)[lo]


def window_hashes(units: np.ndarray, length: int) -> np.ndarray:
    """Hash of every ``length`` consecutive units (shorter output), by doubling."""
    if length == 1 or len(units) < length:
        return units[:max(0, len(units) - length + 1)]
    half = length // 2
    part = window_hashes(units, half)
    if length % 2 == 0:
        return joined(part[:-half], part[half:])
    even = joined(part[:-half], part[half:])
    return joined(even[:-1], units[length - 1:])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column (nulls empty), and where each row begins (one more at the end)."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32,
                            count=len(column) + 1, offset=column.offset * (8 if wide else 4)).astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


# Bytes of folded words: A-Z become a-z, other ASCII but digits ends a word (0).
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[:0x80] = 0
for _first, _last in (("0", "9"), ("a", "z")):
    FOLDED[ord(_first):ord(_last) + 1] = np.arange(ord(_first), ord(_last) + 1)
FOLDED[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def word_bounds(data: np.ndarray, starts: np.ndarray,
                seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``from, to, row`` of every word: a run of ``seen`` bytes (no white space by default) inside one row."""
    if len(data) == 0:
        return (np.empty(0, np.int64),) * 3
    seen = ~_SPACE[data] if seen is None else seen
    begins = starts[:-1][starts[:-1] < len(data)]
    first = seen.copy()
    first[1:] &= ~seen[:-1]
    first[begins] = seen[begins]
    last = seen.copy()
    last[:-1] &= ~seen[1:]
    ends = begins[begins > 0] - 1
    last[ends] = seen[ends]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last) + 1
    return lo, hi, np.searchsorted(starts, lo, "right") - 1
