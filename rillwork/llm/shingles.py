"""Words and word shingles of a batch of texts as 64-bit hashes, and their hash permutations.

Everything works on the UTF-8 buffer of an Arrow column, so a text costs a few
array operations per word and no Python object per word. A batch is cut into
slices of about ``SLICE_BYTES``, never inside a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.ones(256, dtype=bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about ``most`` bytes; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield i, raw[at[i]:at[j]], at[i:j + 1] - at[i]
        i = j


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text and the end).

    Words are runs without space or \\x09-\\x0D; ``lower`` folds A-Z only.
    """
    n = len(raw)
    padded = np.zeros(n + 8, dtype=np.uint8)
    padded[:n] = _LOWER[raw] if lower else raw
    inside = _IN_WORD[padded[:n]]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(begins)
    size = np.flatnonzero(ends) + 1 - start
    lanes = np.ndarray((n + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = size.astype(np.uint64) * _ODD
    alive, at, left = np.arange(len(start)), start, size
    while len(alive):
        lane = lanes[at].copy()
        short = left < 8
        lane[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[alive] = mix(h[alive] ^ lane)
        more = left > 8
        alive, at, left = alive[more], at[more] + 8, left[more] - 8
    return h, np.searchsorted(start, offsets)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text.

    A text of fewer than ``k`` words has its whole word sequence as one shingle;
    a text without words (or null) has none.
    """
    for row, raw, offsets in slices(texts):
        h, first = word_hashes(raw, offsets)
        runs = h.copy()
        for j in range(1, k):
            runs = mix(runs[:max(len(runs) - 1, 0)] * _ODD ^ h[j:])
        for d in range(len(offsets) - 1):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= k:
                yield row + d, np.unique(runs[a:b - k + 1])
            elif b > a:
                whole = h[a:a + 1].copy()
                for j in range(a + 1, b):
                    whole = mix(whole * _ODD ^ h[j:j + 1])
                yield row + d, whole
            else:
                yield row + d, h[:0]


class Permutations:
    """Strongly universal hashes ``(a*x + b) mod 2**64 >> 32`` of 32-bit values."""

    CHUNK = 256

    def __init__(self, count: int, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.a = rng.integers(0, 2**64, count, dtype=np.uint64, endpoint=False)
        self.b = rng.integers(0, 2**64, count, dtype=np.uint64, endpoint=False)

    def values(self, shingles: np.ndarray) -> np.ndarray:
        v = np.multiply.outer(shingles >> np.uint64(32), self.a)
        v += self.b
        return v

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        """Least value under each permutation; the greatest possible for an empty set."""
        low = np.full(len(self.a), 2**64 - 1, dtype=np.uint64)
        for i in range(0, len(shingles), self.CHUNK):
            np.minimum(low, self.values(shingles[i:i + self.CHUNK]).min(axis=0), out=low)
        return low >> np.uint64(32)

    def extremes(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest value under each permutation."""
        low = np.full(len(self.a), 2**64 - 1, dtype=np.uint64)
        high = np.zeros(len(self.a), dtype=np.uint64)
        for i in range(0, len(shingles), self.CHUNK):
            v = self.values(shingles[i:i + self.CHUNK])
            np.minimum(low, v.min(axis=0), out=low)
            np.maximum(high, v.max(axis=0), out=high)
        return low >> np.uint64(32), high >> np.uint64(32)
