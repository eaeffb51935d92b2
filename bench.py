"""Time the 22 workloads on the tables of $BENCH_SF_DIR; print one JSON line.

`queries` are the given tables as they are. `tuned` are the same workloads on the tuned
layout written from them, with the summary; its build time is `tuned_build`.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roost.measure.timing import time_workloads
from roost.plans import layouts
from roost.session import build_session, fresh_scratch
from roost.sources import mapped
from roost.sources.stored import load_layout


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "roost-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    lake = mapped.marketplace(spark, sf_dir)
    time_workloads(lake, 1)  # the JVM compiles the code that all workloads share
    queries = time_workloads(lake, runs)

    started = time.perf_counter()
    path = fresh_scratch(spark, "bench")
    layouts.write_tuned_layout(spark, path, layouts.star_tables(lake), layouts.facts_of(lake))
    build = time.perf_counter() - started
    tuned = time_workloads(load_layout(spark, path, mapped.START, by_month=True), runs)

    print(
        json.dumps(
            {
                "metric": "total of 22 workloads, median wall time, all columns computed",
                "value": round(sum(queries.values()), 4),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "tuned_total": round(sum(tuned.values()), 4),
                "tuned": tuned,
                "tuned_build": round(build, 4),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
