"""Window calculations over totals.

The functions that order a whole table (`running`, `trailing_sum_and_rows`, `previous`)
are for tables with one row per month or day. Listings are too many for one task, and so
may neighbourhoods be: `cumulative_share` and `global_rank` cut the order into slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64

_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def running(value: str, order: str) -> Column:
    """Running total."""
    return F.sum(value).over(Window.orderBy(order).rowsBetween(*_TO_HERE))


def trailing_sum_and_rows(value: str, order: str, rows: int) -> tuple[Column, Column]:
    """Sum and number of the last ``rows`` rows, fewer at the start."""
    recent = Window.orderBy(order).rowsBetween(1 - rows, Window.currentRow)
    return F.sum(value).over(recent), F.count(value).over(recent)


def previous(value: str, order: str) -> Column:
    """Value of the row before; NULL for the first."""
    return F.lag(value).over(Window.orderBy(order))


def top_per_group(df: DataFrame, group: str, value: str, n: int, rank_name: str) -> DataFrame:
    """Rows with one of the ``n`` highest values of their group, ties included.

    Spark turns the filter into a limit per group that runs before the shuffle, so
    only candidates move however large a group is.
    """
    highest_first = Window.partitionBy(group).orderBy(F.desc(value))
    return df.withColumn(rank_name, F.dense_rank().over(highest_first)).where(F.col(rank_name) <= n)


_STEPS = f"array({', '.join(f'{i}D/{SLICES}' for i in range(1, SLICES))})"


def _sliced_sql(value: str, tie_break: str | None = None) -> str:
    """``borders`` and ``sliced``: the rows of ``{rows}`` with their number of slice, ``_slice``.

    Slices follow the order of ``value`` from the highest down. The borders are ``SLICES``
    quantiles from a sketch, one small aggregate that runs as a subquery of the plan: no job
    of its own, one result for all tasks of the query, repeated ones too. A value that is
    itself a border, so any value of more than a ``SLICES``-th of the rows, gets a slice of
    its own, odd by number; with a (numeric) tie break this is cut by the tie break's
    quantiles in turn. How exact the sketch is decides how even slices are, never the order.
    NULL comes last, in an odd slice too.
    """
    quantiles = lambda c: f"array_distinct(percentile_approx({c}, {_STEPS}, {100 * SLICES}))"
    shared = f"coalesce(array_contains(_borders.of_values, {value}), false)"
    place = f"""CASE WHEN {value} IS NULL THEN {2 * SLICES + 1}
      ELSE 2 * size(filter(_borders.of_values, b -> b > {value})) + int({shared}) END"""
    ties = "NULL"
    if tie_break:
        ties = quantiles(tie_break)
        inside = f"size(filter(_borders.of_ties, b -> b < {tie_break}))"
        place = f"({place}) * {SLICES} + IF({shared}, {inside}, 0)"
    # Not nullable, so that joins on it add no null test that works it out once more.
    return f"""borders AS (SELECT struct({quantiles(value)} AS of_values, {ties} AS of_ties) AS b FROM {{rows}}),
    bordered AS (SELECT *, (SELECT b FROM borders) AS _borders FROM {{rows}}),
    sliced AS (SELECT * EXCEPT (_borders), coalesce({place}, -1) AS _slice FROM bordered)"""


def sliced(df: DataFrame, value: str, tie_break: str | None = None) -> DataFrame:
    """Add ``_slice``, a place in the order of ``value`` that rows of one task may share."""
    return df.sparkSession.sql(f"WITH {_sliced_sql(value, tie_break)} SELECT * FROM sliced", rows=df)


def global_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add the rank over all rows, highest first; equal values share a rank.

    Rows are ranked inside their slice, equal values always meet in one. What stands before
    a slice is looked up in the counts of the slices (at most two for each border). In the
    slice of one value all rows are first, so they are ranked where they are found and need
    not meet.
    """
    return df.sparkSession.sql(
        f"""WITH {_sliced_sql(value)},
        counts AS (SELECT _slice, count(*) AS n FROM sliced GROUP BY _slice),
        listed AS (SELECT collect_list(struct(_slice, n)) AS every FROM counts),
        ranked AS (SELECT *, (SELECT every FROM listed) AS _every, rank() OVER (
          PARTITION BY _slice, IF(_slice % 2 = 1, spark_partition_id(), -1) ORDER BY {value} DESC) AS _inside
          FROM sliced)
        SELECT * EXCEPT (_slice, _every, _inside), _inside + aggregate(
          filter(_every, c -> c._slice < ranked._slice), 0L, (total, c) -> total + c.n) AS {name}
        FROM ranked""",
        rows=df,
    )


def cumulative_share(df: DataFrame, value: str, tie_break: str) -> DataFrame:
    """Add ``cum`` and ``grand``: running total from the highest value down, and the total.

    A prefix sum in three steps, none of which needs all rows in one task:

    1. Cut the rows into slices of (value descending, tie break), so that even one value
       shared by a third of the rows is cut up, and shuffle them by slice, once.
    2. Total each slice. There are at most ``2 * SLICES ** 2``, which bounds both the
       one-task running total over them and what is broadcast.
    3. Run the total inside each slice, from where the slices before it ended.
    """
    exact = f"CAST(coalesce({value}, 0) AS DECIMAL(20,0))"
    return df.sparkSession.sql(
        f"""WITH {_sliced_sql(value, tie_break)},
        dealt AS (SELECT /*+ REPARTITION(_slice) */ * FROM sliced),
        -- The tie break is counted so that both uses of the slices read the same shuffle.
        totals AS (SELECT _slice AS _of, sum({exact}) AS total, count({tie_break}) AS n FROM dealt GROUP BY _slice),
        starts AS (SELECT _of,
          coalesce(sum(total) OVER (ORDER BY _of ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before,
          sum(total) OVER (ORDER BY _of ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS grand
          FROM totals WHERE n >= 0)
        SELECT /*+ BROADCAST(starts) */ * EXCEPT (_slice, _of, _before, grand), _before + sum({exact}) OVER (
          PARTITION BY _slice ORDER BY {value} DESC, {tie_break}
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum, grand
        FROM dealt JOIN starts ON _slice = _of""",
        rows=df,
    )
