"""Minimal perfect hashes of terms, in shards, with stored keys.

A shard numbers its keys from 0 without a gap. At each level keys go to the bits of an
array about twice their number; bits hit once are set and settle their key, the other keys
go on to the next level. The number of a key is the rank of its bit among all set bits. So
a lookup always gives some number for a strange term: the key stored there is compared
before it counts. Keys of up to 31 bytes are stored as they are, longer ones as a zero byte
and their SHA-256, so a key takes 33 bytes at most; terms hold no zero byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import xxhash

from roost.llm.words import mix

SEED = 42  # of Spark's xxhash64, which deals terms to shards
_LEVEL = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
_ONE = np.uint64(1)


def stored(term: bytes) -> bytes:
    return term if len(term) < 32 else b"\0" + hashlib.sha256(term).digest()


def hashes(terms: Sequence[bytes], seed: int = SEED) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(term, seed) for term in terms), np.uint64, len(terms))


def shard_of(hashed: np.ndarray, shards: int) -> np.ndarray:
    """As Spark's ``pmod(xxhash64(term), shards)``."""
    return np.mod(hashed.view(np.int64), np.int64(shards))


def _places(hashed: np.ndarray, level: int, sizes: np.ndarray | np.uint64) -> np.ndarray:
    return mix(hashed + np.uint64(_LEVEL * (level + 1) & _M64)) % sizes


@dataclass(frozen=True)
class Shard:
    """``words`` are the bit arrays of all levels, ``sizes`` their lengths in bits."""

    seed: int
    sizes: np.ndarray
    words: np.ndarray

    @classmethod
    def build(cls, terms: Sequence[bytes]) -> Shard:
        seed, left = SEED, hashes(terms)
        while len(np.unique(left)) < len(terms):
            seed += 1
            left = hashes(terms, seed)
        sizes, words = [], []
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            places = _places(left, len(sizes), np.uint64(size)).astype(np.int64)
            alone = np.bincount(places, minlength=size)[places] == 1
            bits = np.zeros(size, np.uint8)
            bits[places[alone]] = 1
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone]
        packed = np.concatenate(words) if words else np.empty(0, "<u8")
        return cls(seed, np.array(sizes, np.int32), packed)

    def slots(self, terms: Sequence[bytes]) -> np.ndarray:
        return PerfectHash([self], [0], 1, [[]], check=False).slots(terms)


class PerfectHash:
    """Shards of one vocabulary, all or some, with one numbering for all of them.

    ``numbers`` are the shards' numbers out of ``shards``, ``keys`` each shard's keys by slot.
    """

    def __init__(
        self,
        parts: Sequence[Shard],
        numbers: Sequence[int],
        shards: int,
        keys: Sequence[Sequence[bytes]],
        check: bool = True,
    ):
        self.shards, self.check = shards, check
        self.local = np.full(shards, -1, np.int64)
        self.local[list(numbers)] = np.arange(len(numbers))
        depth = max((len(p.sizes) for p in parts), default=0)
        self.sizes = np.zeros((depth, len(parts)), np.uint64)
        self.at = np.zeros((depth, len(parts)), np.int64)
        at = 0
        for i, part in enumerate(parts):
            for level, size in enumerate(part.sizes):
                self.sizes[level, i], self.at[level, i] = size, at
                at += int(size) // 64
        self.words = np.concatenate([p.words for p in parts]) if parts else np.empty(0, np.uint64)
        set_bits = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = np.cumsum(set_bits) - set_bits
        self.reseeded = {i: p.seed for i, p in enumerate(parts) if p.seed != SEED}
        sizes = [len(k) for k in keys]
        self.starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        lengths = np.fromiter((len(x) for k in keys for x in k), np.int64)
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        self.blob = b"".join(x for k in keys for x in k)

    def slots(self, terms: Sequence[bytes]) -> np.ndarray:
        """The slot of each term, -1 for a term that is not a key of these shards."""
        hashed = hashes(terms)
        local = self.local[shard_of(hashed, self.shards)]
        for i, seed in self.reseeded.items():
            moved = np.flatnonzero(local == i)
            hashed[moved] = hashes([terms[k] for k in moved], seed)
        found = np.full(len(terms), -1, np.int64)
        left = np.flatnonzero(local >= 0)
        for level in range(len(self.sizes)):
            sizes = self.sizes[level, local[left]]
            left, sizes = left[sizes > 0], sizes[sizes > 0]
            if not len(left):
                break
            places = _places(hashed[left], level, sizes)
            word = self.at[level, local[left]] + (places >> np.uint64(6)).astype(np.int64)
            bit = _ONE << (places & np.uint64(63))
            hit = (self.words[word] & bit) > 0
            below = np.bitwise_count(self.words[word[hit]] & (bit[hit] - _ONE))
            found[left[hit]] = self.ranks[word[hit]] + below
            left = left[~hit]
        if not self.check:
            return found
        blob, begins, ends = self.blob, self.begins, self.ends
        for k in np.flatnonzero(found >= 0).tolist():
            slot = found[k]
            if blob[begins[slot] : ends[slot]] != stored(terms[k]):
                found[k] = -1
        return found
