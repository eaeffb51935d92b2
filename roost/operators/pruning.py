"""Day filters that also skip the directories of other months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.functions.calendar import DayRange


def in_days(df: DataFrame, day_column: str, days: DayRange, month_column: str | None = None) -> DataFrame:
    """Rows whose day lies in ``days``.

    Spark cannot tell that a date filter bounds a month directory. Name the
    ``month_column`` a table is partitioned by, and the implied month range is added;
    then only those directories are listed and read.
    """
    wanted = days.holds(day_column)
    if month_column is not None:
        wanted &= F.col(month_column).between(*days.month_keys())
    return df.where(wanted)
