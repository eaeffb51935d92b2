"""Physical layouts of the benchmark tables: plain, tuned, bucketed, CSV."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 4_000_000
# A task sorts all of a bucket, about 160 bytes a row.
ROWS_PER_BUCKET = 2_000_000
# A bucket with more than this many times the mean is too uneven to be read by one task.
UNEVEN = 4


@dataclass(frozen=True)
class TunedTable:
    """Columns kept, the month column, and the order of rows inside files.

    ``unique`` ends the order with a key, so that any run of equal rows can be cut.
    """

    columns: tuple[str, ...]
    month: str | None
    order: tuple[str, ...]
    unique: str

    @property
    def leading(self) -> str | None:
        """The column whose values are dealt to files: the day, or the month without one."""
        return self.order[0] if self.order else self.month


# Columns and sort orders of the layout.
TUNED = {
    "transactions": TunedTable(
        ("txn_id", "booking_id", "listing_id", "txn_date", "txn_month", "amount", "status",
         "currency", "payment_method"),
        "txn_month", ("txn_date", "status", "amount"), "txn_id",
    ),
    "bookings": TunedTable(
        ("booking_id", "listing_id", "guest_id", "checkin_date", "checkin_month", "nights",
         "amount", "status"),
        "checkin_month", ("checkin_date", "status", "amount"), "booking_id",
    ),
    "reviews": TunedTable(
        ("review_id", "listing_id", "reviewer_id", "review_date", "review_month", "rating"),
        "review_month", ("review_date", "rating"), "review_id",
    ),
    "listings": TunedTable(
        ("listing_id", "neighbourhood", "room_type", "price", "minimum_nights"),
        None, (), "listing_id",
    ),
    "summary": TunedTable(
        ("listing_id", "txn_month", "revenue", "txn_count", "avg_ticket", "neighbourhood",
         "room_type"),
        "txn_month", (), "listing_id",
    ),
}


def files_for(rows: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    return max(1, -(-rows // rows_per_file))


Key = date | str | None


def rows_per_key(df: DataFrame, table: TunedTable) -> dict[Key, int]:
    """Rows of each day, or month; a calendar has few. Reads that one column."""
    counts = df.groupBy(F.col(table.leading).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return {row["key"]: row["n"] for row in counts.collect()}


def places(counts: Mapping[Key, int], rows_per_file: int) -> tuple[list[tuple[Key, int, int]], int]:
    """First writer and number of writers of each key, and how many writers there are.

    Keys in order fill one writer after the other; one with more rows than fit in a file
    gets several of its own, with a tenth to spare since it is cut by hash.
    """
    found, at, filled = [], 0, 0
    for key in sorted(counts, key=lambda k: (k is not None, k)):
        rows = counts[key]
        width = files_for(rows, rows_per_file)
        if width > 1:
            width = files_for(rows, max(1, rows_per_file * 9 // 10))
        if filled and (width > 1 or filled + rows > rows_per_file):
            at, filled = at + 1, 0
        found.append((key, at, width))
        if width > 1:
            at, filled = at + width, 0
        else:
            filled += rows
    return found, at + (filled > 0)


def _dealt(df: DataFrame, table: TunedTable, counts: Mapping[Key, int], rows_per_file: int) -> DataFrame:
    """Rows moved to the writer of their key, in one shuffle.

    The borders come from ``counts``, not from a sample, so the input runs once. The list of
    keys is as long as the calendar, which bounds the broadcast. Keys it lacks are spread by
    hash: counts of an earlier or a wider table will do.
    """
    found, writers = places(counts, rows_per_file)
    if not found:
        return df
    kind = df.schema[table.leading].dataType.simpleString()
    known = df.sparkSession.createDataFrame(found, f"_key {kind}, _first int, _width int")
    leading = F.col(table.leading)
    # Copies of one id from different tasks go to different files.
    part = F.pmod(F.xxhash64(table.unique) + F.spark_partition_id(), F.col("_width"))
    stray = F.pmod(F.xxhash64(table.leading), F.lit(writers))
    placed = df.join(F.broadcast(known), leading.eqNullSafe(F.col("_key")), "left")
    to = F.coalesce(F.col("_first") + part, stray).cast("int")
    return placed.withColumn("_to", to).repartitionById(writers, "_to").select(*df.columns)


def write_tuned(
    df: DataFrame,
    path: str,
    table: TunedTable,
    counts: Mapping[Key, int] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Pruned, partitioned by month, sorted, in files of about ``rows_per_file`` rows.

    ``counts`` are the rows of each day (see ``rows_per_key``); not given, they are counted,
    which reads the day column of ``df`` once more. A day or month with a third of the rows
    gets a third of the writers, small months share one, every file holds few days, and row
    groups have narrow bounds. The month leads the sort: a partitioned write wants it first
    and would sort again otherwise, losing the rest.

    A table without months, the dimension, is cut by size at run time.
    """
    rows = df.select(*table.columns)
    if table.leading is None:
        rows = rows.hint("rebalance")
    else:
        counts = rows_per_key(df, table) if counts is None else counts
        rows = _dealt(rows, table, counts, rows_per_file)
    order = [c for c in (table.month, *table.order, table.unique) if c]
    writer = rows.sortWithinPartitions(*order).write.mode("overwrite")
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    if table.month:
        writer = writer.partitionBy(table.month)
    writer.option("partitionOverwriteMode", "static").parquet(path)


def buckets_for(rows: int, least: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """As many buckets as keep each at ``rows_per_bucket``, however many rows there are."""
    return max(least, files_for(rows, rows_per_bucket))


def is_even(df: DataFrame, key: str, buckets: int) -> bool:
    """Whether no bucket is much larger than the others. Reads the key column."""
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    sizes = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return not row["rows"] or row["most"] * buckets <= UNEVEN * row["rows"]


def write_bucketed(
    df: DataFrame, name: str, path: str, table: TunedTable, key: str, buckets: int
) -> None:
    """The tuned columns by month, each month cut by the hash of ``key``, as table ``name``.

    Two tables cut alike by the key they are joined on need no shuffle for it, and neither
    does a sum per key. One task writes, and later reads, all of a bucket: see ``is_even``.
    """
    order = [c for c in (*table.order, table.unique) if c]
    writer = df.select(*table.columns).repartition(buckets, key).write.mode("overwrite")
    if table.month:
        writer = writer.partitionBy(table.month)
    writer.bucketBy(buckets, key).sortBy(*order).option("path", path).saveAsTable(name)


def declare_bucketed(
    spark: SparkSession, name: str, path: str, schema: str, table: TunedTable, key: str, buckets: int
) -> None:
    """Declare stored buckets as a table, in a session whose catalog does not know them."""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    order = ", ".join(c for c in (*table.order, table.unique) if c)
    months = f"PARTITIONED BY ({table.month}) " if table.month else ""
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING PARQUET {months}"
        f"CLUSTERED BY ({key}) SORTED BY ({order}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    if table.month:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def write_plain(df: DataFrame, path: str, files: int | None = None) -> None:
    """Every column, unsorted and unpartitioned; ``files`` joins tasks into fewer files."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header line in each file."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").csv(path, header=True)
