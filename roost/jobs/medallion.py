"""Raw records to clean tables to marts.

    python -m roost.jobs.medallion --bronze PATH --silver PATH --gold PATH
    python -m roost.jobs.medallion --root PATH --generate [--ingest-date D] [--listings N]

The first form works on what was landed. The second lands generated records first.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date

from roost.jobs.generate_raw import add_size_options, raw_data
from roost.paths import DATASETS, LakePaths
from roost.plans import medallion
from roost.session import build_session


def main(argv: list[str]) -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--root", help="base path of all three layers")
    for layer in ("bronze", "silver", "gold"):
        options.add_argument(f"--{layer}", help=f"base path of the {layer} layer")
    options.add_argument("--generate", action="store_true", help="land generated records first")
    options.add_argument("--ingest-date", default=date.today().isoformat())
    options.add_argument(
        "--gate", nargs="*", default=["reviews"], choices=DATASETS, help="clean tables to check"
    )
    options.add_argument("--samples", type=int, default=10, help="rows to show of each mart")
    add_size_options(options)
    chosen = options.parse_args(argv)
    if chosen.root:
        paths = LakePaths.under(chosen.root)
    elif chosen.bronze and chosen.silver and chosen.gold:
        paths = LakePaths(chosen.bronze, chosen.silver, chosen.gold)
    else:
        options.error("give --root, or all of --bronze, --silver and --gold")
    spark = build_session("roost-medallion")
    try:
        raw = raw_data(chosen).tables(spark) if chosen.generate else None
        result = medallion.run(spark, paths, raw, chosen.ingest_date, chosen.gate)
        print(result.as_text())
        medallion.show_samples(spark, paths, result.marts, chosen.samples)
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
