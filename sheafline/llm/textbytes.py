"""Whole texts as byte arrays: words, lines and their hashes for many rows at once, inside Arrow tasks.

Rows are handled in runs of about ``RUN_BYTES``; a longer text is a run of its own. Word hashes are made in segments,
so the extra memory of a run is a small multiple of its bytes. Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 19
SEGMENT_BYTES = 1 << 18

GAP = np.zeros(256, dtype=bool)
GAP[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_LETTER = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def runs(column: pa.Array, size: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each run of about ``size`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(off, off[row] + size, "right")) - 1)
        yield row, end, buf[off[row] : off[end]], off[row : end + 1] - off[row]
        row = end


def spans(gap: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal stretches without a gap; rows end stretches too."""
    inside = ~gap
    first, last = inside.copy(), inside.copy()
    first[1:] &= gap[:-1]
    last[:-1] &= gap[1:]
    filled = off[:-1] < off[1:]
    begin, end = off[:-1][filled], off[1:][filled] - 1
    first[begin], last[end] = inside[begin], inside[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, SEGMENT_BYTES * 2)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps)
    return _POWERS


def hashed(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes: a polynomial in the bytes, differences of its prefix sums."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SEGMENT_BYTES, "right")))
        a, b = starts[i], ends[j - 1]
        power, inverse = _powers(int(b - a) + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_LETTER[buf[a:b]] * power[: b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(_BASE)
        i = j
    return mixed(out)


def per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many flags each row has."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[off[1:]] - sums[off[:-1]]
