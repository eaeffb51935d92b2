"""Casts that turn malformed text into NULL, whatever the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(column: str) -> Column:
    """Text to double. NaN and infinities count as malformed."""
    parsed = F.col(column).try_cast("double")
    return F.when(F.abs(parsed) < float("inf"), parsed)


def whole(column: str) -> Column:
    """Text to int; a decimal fraction is cut off ('4.7' gives 4).

    The plain cast settles nearly every row. Only text it rejects is looked at
    again, and only digits with a fraction pass that second look.
    """
    text = F.col(column)
    with_fraction = F.when(
        text.rlike(r"^\s*[+-]?\d+\.\d*\s*$"), text.try_cast("double").try_cast("int")
    )
    return F.coalesce(text.try_cast("int"), with_fraction)


def day(column: str) -> Column:
    return F.col(column).try_cast("date")


def moment(column: str) -> Column:
    """A time without a day is malformed; the plain cast would take today's."""
    text = F.col(column).cast("string")
    return F.when(~text.rlike(r"^\s*T?\d{1,2}:"), F.col(column).try_cast("timestamp"))


def filled(column: str) -> Column:
    """True for text with something besides blanks; NULL text does not pass."""
    return F.trim(F.col(column)) != ""
