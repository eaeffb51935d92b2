"""Month keys and half-open day ranges."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(day: Column) -> Column:
    """'yyyy-MM' of a date."""
    return F.date_format(day, "yyyy-MM")


@dataclass(frozen=True)
class DayRange:
    """Days from ``first`` up to, but not including, ``end``."""

    first: date
    end: date

    @classmethod
    def after(cls, origin: date, offset: int, length: int) -> DayRange:
        first = origin + timedelta(days=offset)
        return cls(first, first + timedelta(days=length))

    def holds(self, column: str) -> Column:
        return (F.col(column) >= F.lit(self.first)) & (F.col(column) < F.lit(self.end))

    def month_keys(self) -> tuple[str, str]:
        """Keys of the first and the last month touched."""
        last = self.end - timedelta(days=1)
        return f"{self.first:%Y-%m}", f"{last:%Y-%m}"
