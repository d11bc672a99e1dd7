"""Vectorised 64-bit hashing of byte ranges, for use inside tasks."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    ups, downs = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    ups[0] = downs[0] = 1
    return np.cumprod(ups, dtype=np.uint64), np.cumprod(downs, dtype=np.uint64)


def _room(n: int) -> int:
    return 1 << max(16, int(n).bit_length())


class RangeHasher:
    """Hashes of any ranges of a byte array, independent of where they stand."""

    def __init__(self, data: np.ndarray):
        ups, self.downs = _powers(_room(len(data) + 1))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * ups[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.downs[starts] + (ends - starts).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """The hash of the window of ``size`` bytes at every position that has one."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.downs[:n] + np.uint64(size))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array (null: empty) and each text's bounds in them."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not data.size:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def groups_of(bounds: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Cuts texts into runs of about ``size`` bytes; a longer text is a run of its own."""
    out, first, n = [], 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        out.append((first, last))
        first = last
    return out


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of consecutive texts, and each text's bounds among them."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    last = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    starts[first] = inside[first + 1]
    ends[last] = inside[last + 1]
    a, b = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return RangeHasher(data).ranges(a, b), np.searchsorted(a, bounds)
