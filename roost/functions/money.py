"""Money is stored as double dollars and added up as whole cents and parts of a cent.

Both are bigints, so they add exactly and in any order: a total does not depend on how the
rows were partitioned, and it stays in generated code; summing decimals gives the same
totals at many times the cost. Rounding to cents comes once, after the sum. Parts of a cent
are kept to a millionth, for up to 9e12 rows in a total. Amounts that are NaN, infinite or
beyond ``MOST`` raise an error, as do totals that a bigint cannot hold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = 1_000_000  # of a cent
MOST = 9e16  # dollars times 100 still fit a bigint


def cents(amount: Column) -> Column:
    return F.floor(amount * 100 + 0.5)


def split(amount: Column) -> tuple[Column, Column]:
    """Whole cents, rounded down, and the rest in parts of a cent."""
    wrong = F.raise_error(F.lit("an amount of money is NaN, infinite or too large"))
    exact = F.when(F.abs(amount) >= MOST, wrong).otherwise(amount * 100)
    whole = F.floor(exact)
    return whole, F.floor((exact - whole) * PARTS + 0.5)


def joined(whole: Column, parts: Column) -> Column:
    """Cents, rounded half up, of summed whole cents and summed parts."""
    return whole + F.call_function("div", parts + PARTS // 2, F.lit(PARTS))


def total_cents(amount: str | Column = "amount") -> Column:
    whole, parts = split(F.col(amount) if isinstance(amount, str) else amount)
    return joined(F.sum(whole), F.sum(parts))


def dollars(whole_cents: Column) -> Column:
    return whole_cents.cast("double") / 100
