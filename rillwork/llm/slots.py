"""Which words of a text may stand in the slots of known patterns, by array operations on its code points.

A pattern is two words and the place of the slot: behind them, before them or between them. A word's hash is a
polynomial of its code points, taken from prefix sums, so all words of a text are hashed at once; two
word hashes and the place make a key, and a table of ``PLACES`` bits tells whether a pattern has it. The table may say yes to
other words too (callers compare the patterns themselves), never no to a pattern's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.shingles import mix

PLACES = 1 << 24
BEHIND, BEFORE, BETWEEN = 1, 2, 3  # where the slot is
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_SPACES = np.array([chr(c).isspace() for c in range(0x3001)] + [False])


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, b, dtype=np.uint64))]) for b in (_BASE, _INVERSE))


def _key(first: np.ndarray, second: np.ndarray, where: int) -> np.ndarray:
    return mix((first * _ODD ^ second) + np.uint64(where)) & np.uint64(PLACES - 1)


class Windows:
    """The words of a text, with the signs ``trim`` at their ends set aside, and the keys of the patterns around each."""

    def __init__(self, text: str, lowered: str, trim: np.ndarray):
        codes = np.frombuffer(lowered.encode("utf-32-le"), dtype="<u4")
        inside = ~_SPACES[np.minimum(codes, 0x3001)]
        padded = np.zeros(len(codes) + 2, dtype=bool)
        padded[1:-1] = inside
        self.begin, self.end = np.flatnonzero(padded[1:-1] & ~padded[:-2]), np.flatnonzero(padded[1:-1] & ~padded[2:]) + 1
        solid = np.flatnonzero(inside & ~trim[np.minimum(codes, 128)])
        low, high = np.searchsorted(solid, self.begin), np.searchsorted(solid, self.end)
        some = high > low
        solid = np.append(solid, 0)
        # a word of signs alone has all of them before it
        self.start = np.where(some, solid[low], self.end)
        self.stop = np.where(some, solid[high - 1] + 1, self.end)
        powers, inverse = _powers(1 << max(12, len(codes).bit_length()))
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:len(codes)])])
            self.hashes = mix((sums[self.stop] - sums[self.start]) * inverse[self.start])

    def candidates(self, table: np.ndarray) -> np.ndarray:
        """Numbers of the words around which ``table`` may know a pattern."""
        n = len(self.begin)
        if not n:
            return np.zeros(0, dtype=np.int64)
        nothing = word_hash("")
        h = np.concatenate([[nothing] * 2, self.hashes, [nothing] * 2]).astype(np.uint64)
        i = np.arange(n)
        before, behind = self.start > self.begin, self.stop < self.end
        near_left, far_left = np.where(before, nothing, h[i + 1]), np.where(before, h[i + 1], h[i])
        near_right, far_right = np.where(behind, nothing, h[i + 3]), np.where(behind, h[i + 3], h[i + 4])
        lefts, rights = np.minimum(i + before, 2), np.minimum(n - 1 - i + behind, 2)
        with np.errstate(over="ignore"):
            found = _known(table, _key(far_left, near_left, BEHIND)) & (lefts == 2)
            found |= _known(table, _key(near_right, far_right, BEFORE)) & (rights == 2)
            found |= _known(table, _key(near_left, near_right, BETWEEN)) & (lefts > 0) & (rights > 0)
        return np.flatnonzero(found)


def _known(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return (table[keys >> np.uint64(3)] >> (keys & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


@lru_cache(maxsize=1 << 16)
def word_hash(word: str) -> np.uint64:
    codes = np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    with np.errstate(over="ignore"):
        return mix(((codes + np.uint64(1)) * _powers(1 << max(12, len(codes).bit_length()))[0][:len(codes)]).sum(keepdims=True, dtype=np.uint64))[0]


def keys_of(pattern: str) -> list[int]:
    """The keys of a pattern: two words and ``_`` for the slot, joined by spaces. A word that is itself ``_`` leaves several readings."""
    a, b, c = pattern.split(" ")
    pairs = [(x, y, where) for x, y, slot, where in ((a, b, c, BEHIND), (b, c, a, BEFORE), (a, c, b, BETWEEN)) if slot == "_"]
    with np.errstate(over="ignore"):
        return [int(_key(np.array([word_hash(x)]), np.array([word_hash(y)]), where)[0]) for x, y, where in pairs]


def bits_of(patterns: DataFrame) -> np.ndarray:
    """The table of the column ``pattern``; the driver gets ``PLACES`` / 32 rows at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array([k for p in batch.column(0).to_pylist() for k in keys_of(p)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys >> 5), pa.array((keys & 31).astype(np.int32))], ["at", "bit"])

    words = patterns.select("pattern").mapInArrow(run, "at long, bit int").groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    table = np.zeros(PLACES // 32, dtype="<u4")
    if words.num_rows:
        table[words["at"].to_numpy()] = words["bits"].to_numpy().astype("<u4")
    return table.view(np.uint8)
