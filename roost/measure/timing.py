"""Fair timings: every column of every row is computed."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from roost.plans.marketplace import Marketplace
from roost.plans.workloads import WORKLOADS


def run_to_end(df: DataFrame) -> None:
    """Compute all rows and drop them. A count would let Spark skip unused columns."""
    df.write.format("noop").mode("overwrite").save()


def count_rows(df: DataFrame) -> None:
    """Only count: Spark drops windows, outer joins and sums the count does not need."""
    df.count()


ACTIONS = {"noop": run_to_end, "count": count_rows}


def median_seconds(
    build: Callable[[], DataFrame], runs: int, warm_ups: int = 1, action: str = "noop"
) -> float:
    """Median wall time of planning and running, after warm-up runs."""
    samples = []
    for number in range(warm_ups + runs):
        started = time.perf_counter()
        ACTIONS[action](build())
        if number >= warm_ups:
            samples.append(time.perf_counter() - started)
    return statistics.median(samples)


def time_workloads(
    lake: Marketplace, runs: int, keys: Iterable[str] | None = None, action: str = "noop"
) -> dict[str, float]:
    return {
        key: round(median_seconds(lambda: WORKLOADS[key].plan(lake), runs, action=action), 4)
        for key in keys or WORKLOADS
    }
