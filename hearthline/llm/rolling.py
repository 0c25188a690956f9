"""Hashes of words and windows over the bytes of an Arrow batch, as whole arrays.

All sums and products wrap modulo 2^64.  A string's hash is a polynomial in a fixed
odd base over random values of its bytes, mixed at the end; two different strings
agree with a chance of about 2^-64 (texts built to collide excepted).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK = 1 << 20  # bytes hashed at a time
_BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = np.random.default_rng(20_240_101).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (a new array)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, CHUNK + 1)
        steps = [np.full(n, base % (1 << 64), dtype=np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64))]
        for step in steps:
            step[0] = 1
        _powers[:] = [np.cumprod(step, dtype=np.uint64) for step in steps]
    return _powers[0], _powers[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them; a null row
    is empty.  No copy but for sliced arrays with nulls that hide bytes."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and which words each row has (offsets)."""
    inside = ~_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] = inside[cuts]
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hashes of ascending spans that do not overlap, some spans at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, side="right")))
        base = starts[at]
        part = data[base : ends[to - 1]]
        up, down = powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[part] * up[: len(part)], out=sums[1:])
        first = starts[at:to] - base
        out[at:to] = mix((sums[ends[at:to] - base] - sums[first]) * down[first])
        at = to
    return out


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a sequence of two parts."""
    return mix(left * U64(0xD6E8FEB86659FD93) + right)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hashes of all windows of ``size`` neighbours."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n]
    for k in range(1, size):
        out = out * U64(0xD6E8FEB86659FD93) + hashes[k : k + n]
    return mix(out)


def whole_windows(offsets: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` windows of ``size`` lie within one row."""
    ok = np.ones(max(0, total), dtype=bool)
    for back in range(1, size):
        crossing = offsets[1:-1] - back
        ok[crossing[(crossing >= 0) & (crossing < total)]] = False
    return ok
