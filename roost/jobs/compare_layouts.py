"""Build the plain and the tuned layout and time the 22 workloads on both.

    python -m roost.jobs.compare_layouts --out PATH [--txn-rows N] [--runs N] [--rebuild]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from roost.measure import report
from roost.measure.manifest import read_manifest, save_manifest
from roost.measure.timing import ACTIONS, time_workloads
from roost.plans import layouts
from roost.session import build_session
from roost.sources.stored import load_layout
from roost.sources.synthetic import START, Scale, stored_bytes

# A plain layout has few big files; more rows get more files.
PLAIN_ROWS_PER_FILE = 10_000_000


def _plain_files(scale: Scale) -> dict[str, int]:
    return {d: max(1, -(-scale.rows(d) // PLAIN_ROWS_PER_FILE)) for d in vars(scale)}


def build(spark: SparkSession, out: str, scale: Scale, with_csv: bool) -> None:
    tables = scale.tables(spark)
    layouts.write_plain_layout(f"{out}/plain", tables, _plain_files(scale))
    layouts.write_tuned_layout(spark, f"{out}/tuned", tables)
    if with_csv:
        layouts.write_csv_copy(out, tables)
    sizes = {name: stored_bytes(spark, f"{out}/{name}") for name in ("plain", "tuned")}
    save_manifest(spark, f"{out}/manifest", {"rows": vars(scale), "bytes": sizes})


def is_built(spark: SparkSession, out: str, scale: Scale | None = None) -> bool:
    """Whether both layouts are there to the end, which the manifest, written last, says.

    Layouts of other sizes, or files that came or went since, would be timed under a wrong
    name: an error.
    """
    manifest = read_manifest(spark, f"{out}/manifest")
    if manifest is None:
        return False
    if scale is not None and manifest["rows"] != vars(scale):
        raise ValueError(f"{out} holds {manifest['rows']}, not {vars(scale)}; use --rebuild or another path")
    found = {name: stored_bytes(spark, f"{out}/{name}") for name in manifest["bytes"]}
    if found != manifest["bytes"]:
        raise ValueError(f"files in {out} are not those of its manifest; use --rebuild")
    return True


def run(
    spark: SparkSession,
    out: str,
    scale: Scale,
    runs: int,
    rebuild: bool = False,
    with_csv: bool = False,
    action: str = "noop",
) -> dict:
    out = out.rstrip("/")
    if rebuild or not is_built(spark, out, scale):
        build(spark, out, scale, with_csv)
    timings = {}
    for name in ("plain", "tuned"):
        lake = load_layout(spark, f"{out}/{name}", START, by_month=name == "tuned")
        timings[name] = time_workloads(lake, runs, action=action)
    sizes = {name: stored_bytes(spark, f"{out}/{name}") for name in timings}
    result = report.compare(timings["plain"], timings["tuned"], sizes, scale, runs, action)
    report.save(spark, f"{out}/report", result)
    return result


def main(argv: list[str]) -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--out", required=True, help="base path of both layouts and the report")
    options.add_argument("--txn-rows", type=int, default=60_000_000)
    options.add_argument("--booking-rows", type=int, default=12_000_000)
    options.add_argument("--review-rows", type=int, default=12_000_000)
    options.add_argument("--listing-rows", type=int, default=50_000)
    options.add_argument("--runs", type=int, default=3, help="timed runs per query")
    options.add_argument(
        "--action", default="noop", choices=ACTIONS, help="what a timed run does with the rows"
    )
    options.add_argument("--rebuild", action="store_true", help="write the layouts again")
    options.add_argument("--with-csv", action="store_true", help="write a CSV copy of payments too")
    chosen = options.parse_args(argv)
    spark = build_session("roost-compare-layouts")
    scale = Scale(chosen.txn_rows, chosen.booking_rows, chosen.review_rows, chosen.listing_rows)
    try:
        result = run(
            spark, chosen.out, scale, chosen.runs, chosen.rebuild, chosen.with_csv, chosen.action
        )
        print(report.as_markdown(result))
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
