"""Words, lines and shingles, as SQL expressions and as arrays of hashes.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Python's ``bytes.split()`` cuts at the same six.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
SHINGLE = 5

_M64 = (1 << 64) - 1


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("bigint")


def total(numbers: Column) -> Column:
    """Sum of an array of int."""
    return F.aggregate(numbers, F.lit(0).cast("int"), lambda a, x: (a + x).cast("int"))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_POWERS["up"]) < n:
        size = 1 << (n - 1).bit_length()
        for way, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base & _M64, np.uint64)
            steps[0] = 1
            _POWERS[way] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word in order, upper-case A-Z read as lower case."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return np.empty(0, np.uint64)
    inside = np.concatenate(([False], ~_IS_GAP[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    up, down = _powers(len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[_LOWER[raw]] * up)))
    spans = (sums[ends] - sums[starts]) * down[starts]
    return mix(spans + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, of all words if fewer."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    rolled = np.full(count, size, np.uint64)
    for k in range(size):
        rolled = rolled * np.uint64(0xFF51AFD7ED558CCD) + words[k : k + count]
    return np.unique(mix(rolled))
