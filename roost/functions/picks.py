"""Repeatable pseudo-random values that depend on the row's key alone.

``rand(seed)`` changes with the number of partitions; a hash of the key does not,
so the same size and seed give the same data on any cluster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 1_000_000


def below(key: Column, bound: int | Column, salt: str, seed: int = 0) -> Column:
    """Whole number in [0, bound)."""
    return F.pmod(F.xxhash64(key, F.lit(f"{seed}:{salt}")), F.lit(bound) if isinstance(bound, int) else bound)


def between(key: Column, low: int, high: int, salt: str, seed: int = 0) -> Column:
    """Whole number in [low, high]."""
    return below(key, high - low + 1, salt, seed) + low


def chance(key: Column, ratio: float, salt: str, seed: int = 0) -> Column:
    """True for about ``ratio`` of the keys."""
    return below(key, _STEPS, salt, seed) < int(round(ratio * _STEPS))


def cycle(key: Column, values: Sequence[str]) -> Column:
    """The values in turn, by key modulo their number."""
    return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))


def choice(key: Column, values: Sequence, salt: str, seed: int = 0) -> Column:
    """Any of the values, evenly."""
    return F.element_at(
        F.array(*map(F.lit, values)), (below(key, len(values), salt, seed) + 1).cast("int")
    )


def weighted(key: Column, weights: Mapping, salt: str, seed: int = 0) -> Column:
    """Any of the keys of ``weights``, as often as their weight says."""
    drawn = below(key, sum(weights.values()), salt, seed)
    picked, reached = None, 0
    for value, weight in weights.items():
        reached += weight
        hit = drawn < reached
        picked = F.when(hit, F.lit(value)) if picked is None else picked.when(hit, F.lit(value))
    return picked
