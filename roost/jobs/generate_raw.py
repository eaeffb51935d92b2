"""Write generated raw records, with defects and repeats, as JSON lines.

    python -m roost.jobs.generate_raw --out PATH [--listings N] [--seed N] ...
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from roost.paths import DATASETS
from roost.session import build_session
from roost.sinks.tables import write_json_lines
from roost.sources.synthetic_raw import RawData


def run(spark: SparkSession, out: str, data: RawData, datasets: tuple[str, ...] = DATASETS) -> dict[str, int]:
    tables = data.tables(spark)
    return {d: write_json_lines(tables[d], f"{out.rstrip('/')}/{d}") for d in datasets}


def add_size_options(options: argparse.ArgumentParser) -> None:
    defaults = RawData()
    options.add_argument("--listings", type=int, default=defaults.listings)
    options.add_argument("--reviews-per-listing", type=int, default=defaults.reviews_per_listing)
    options.add_argument("--bookings-per-listing", type=int, default=defaults.bookings_per_listing)
    options.add_argument("--dirty-ratio", type=float, default=defaults.dirty_ratio)
    options.add_argument("--duplicate-ratio", type=float, default=defaults.duplicate_ratio)
    options.add_argument("--seed", type=int, default=defaults.seed)


def raw_data(chosen: argparse.Namespace) -> RawData:
    return RawData(
        chosen.listings,
        chosen.reviews_per_listing,
        chosen.bookings_per_listing,
        chosen.dirty_ratio,
        chosen.duplicate_ratio,
        chosen.seed,
    )


def main(argv: list[str]) -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--out", required=True, help="base path to write to")
    options.add_argument("--datasets", nargs="+", default=list(DATASETS), choices=DATASETS)
    add_size_options(options)
    chosen = options.parse_args(argv)
    spark = build_session("roost-generate-raw")
    try:
        for dataset, rows in run(spark, chosen.out, raw_data(chosen), tuple(chosen.datasets)).items():
            print(f"{dataset}: {rows} records")
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
