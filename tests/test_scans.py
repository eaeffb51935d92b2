"""Row groups whose bounds rule them out are not read."""

from pathlib import Path

import pyarrow.parquet as pq

from roost.measure.scans import scans_of
from roost.plans.marketplace import Marketplace
from roost.plans.workloads import WORKLOADS
from roost.sinks.layout import TUNED, write_tuned
from roost.sources import synthetic
from roost.sources.synthetic import START


def test_one_day_reads_the_row_groups_that_may_hold_it(spark, tmp_path, setting):
    """By the metrics of q03's scan and the bounds in the files' footers."""
    rows = synthetic.transactions(spark.range(200_000), 100, 100)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(32 * 1024))
    hadoop.set("parquet.page.size", str(4 * 1024))
    try:
        write_tuned(rows, str(tmp_path), TUNED["transactions"])
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.page.size")
    lake = Marketplace(None, None, None, spark.read.parquet(str(tmp_path)), START, by_month=True)
    days = lake.span(500, 1)
    found = WORKLOADS["q03_single_day"].plan(lake)
    found.collect()
    (scan,) = scans_of(found)
    wanted = all_rows = 0
    files = list(Path(tmp_path, f"txn_month={days.first:%Y-%m}").glob("*.parquet"))
    for file in files:
        footer = pq.ParquetFile(file)
        place = footer.schema_arrow.names.index("txn_date")
        for i in range(footer.num_row_groups):
            group = footer.metadata.row_group(i)
            bounds = group.column(place).statistics
            all_rows += group.num_rows
            wanted += group.num_rows if bounds.min <= days.first <= bounds.max else 0
    assert scan.files == len(files) and scan.rows <= wanted < all_rows / 3
    assert scan.rows >= rows.where(days.holds("txn_date")).count() > 0
