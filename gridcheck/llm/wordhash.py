"""Words of many texts at once, as spans and 64-bit hashes over one byte buffer.

Nothing here makes a Python object per word: a chunk of an Arrow string column
is its UTF-8 bytes and offsets, words are runs of bytes other than x20 and
x09-x0D, and the hash of any span comes from prefix sums of a polynomial
modulo 2^64 over a random byte table, finished with a mixing function. Two
spans of a text of n words collide with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240117)
BYTES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_BYTES = BYTES.copy()
LOWER_BYTES[65:91] = BYTES[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
WINDOW = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def slices(column: pa.Array, rows: int = 1000, size: int = 1_500_000) -> list[tuple[int, int]]:
    """(start, length) of runs of at most rows texts and size bytes, or of one
    longer text: work space is some forty times a run's bytes."""
    if not len(column):
        return []
    length = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.append(0, np.cumsum(length))
    out, at = [], 0
    while at < len(column):
        stop = min(at + rows, max(at + 1, int(np.searchsorted(total, total[at] + size, "right")) - 1))
        out.append((at, stop - at))
        at = stop
    return out


class Texts:
    """A chunk of texts; null counts as empty."""

    _power: tuple[np.ndarray, np.ndarray] = (powers(BASE, 0), powers(INVERSE, 0))

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string()).fill_null("")
        if not len(column):
            offsets = np.zeros(1, np.int64)
        else:
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2] if len(column) else None
        self.data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.n = len(column)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word."""
        n = len(self.data)
        solid = ~IS_SPACE[self.data]
        first = np.zeros(n + 1, bool)
        first[self.offsets] = True
        before = np.zeros(n, bool)
        before[1:] = solid[:-1]
        after = np.zeros(n, bool)
        after[:-1] = solid[1:]
        return np.flatnonzero(solid & (~before | first[:n])), np.flatnonzero(solid & (~after | first[1:])) + 1

    def per_text(self, at: np.ndarray) -> np.ndarray:
        """How many of the ascending places lie in each text."""
        return np.diff(np.searchsorted(at, self.offsets))

    def hashes(self, start: np.ndarray, end: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
        n = len(self.data)
        up, down = Texts._power
        if len(up) <= n:
            up, down = powers(BASE, n), powers(INVERSE, n)
            if n <= 4_000_000:
                Texts._power = (up, down)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(table[self.data] * up[:n], out=total[1:])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def windows(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(word at which it starts, hash) of every run of width words inside one text; counts: words per text."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))
    at = np.flatnonzero(left[:n] >= width)
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        total += words[at + k] * WINDOW[k]
    return at, mix(total)
