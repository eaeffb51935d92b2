"""Write the four benchmark tables at a target size, in the tuned layout.

    python -m roost.jobs.generate_facts --out PATH [--target-gb N] [--domain NAME]

Bytes per row are measured on a sample first, so the target is met as compressed.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from roost.paths import DATASETS
from roost.session import build_session
from roost.sinks.layout import TUNED, write_tuned
from roost.sources.synthetic import measured_row_bytes, scale_for


def run(
    spark: SparkSession, out: str, target_gb: float, domain: str = "all", sample_rows: int = 2_000_000
) -> dict[str, int]:
    scale = scale_for(target_gb * 1e9, measured_row_bytes(spark, sample_rows))
    tables = scale.tables(spark)
    written = {}
    for dataset in DATASETS if domain == "all" else (domain,):
        rows = scale.rows(dataset)
        print(f"{dataset}: {rows:,} rows")
        write_tuned(tables[dataset], f"{out.rstrip('/')}/{dataset}", TUNED[dataset])
        written[dataset] = rows
    return written


def main(argv: list[str]) -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--out", required=True, help="base path to write to")
    options.add_argument("--target-gb", type=float, default=250.0, help="size of the three facts on disk")
    options.add_argument("--domain", default="all", choices=("all", *DATASETS))
    chosen = options.parse_args(argv)
    spark = build_session("roost-generate-facts")
    try:
        run(spark, chosen.out, chosen.target_gb, chosen.domain)
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
