"""Landing raw records, and writing clean tables and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from roost import files
from roost.operators.cleaning import DOMAINS
from roost.paths import LakePaths
from roost.schemas import CLEAN_PARTITION, MART_ORDER, MART_PARTITION
from roost.session import fresh_scratch


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and their number once they were written: counting costs no second run."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def _partition_name(declared: str | None) -> str | None:
    return declared.split()[0] if declared else None


def _sort_key(text: str) -> Column:
    return F.desc(text.removesuffix(" DESC")) if text.endswith(" DESC") else F.asc(text)


def land(df: DataFrame, paths: LakePaths, dataset: str, ingest_date: str) -> int:
    """Store raw records unchanged as JSON lines under their ingest date.

    Landing a date again replaces that date and leaves the others alone.
    """
    rows, observed = _counted(df)
    rows.write.mode("overwrite").json(paths.landed(dataset, ingest_date), ignoreNullFields=False)
    return observed.get["rows"]


def write_json_lines(df: DataFrame, path: str) -> int:
    rows, observed = _counted(df)
    rows.write.mode("overwrite").json(path, ignoreNullFields=False)
    return observed.get["rows"]


def write_clean(
    df: DataFrame, paths: LakePaths, dataset: str, *, only_partitions: bool = False
) -> int:
    """Write a clean table: replace it whole, so that no row of an earlier run is left.

    With ``only_partitions``, for incremental loads, only the partitions that occur in
    ``df`` are replaced, and those that still hold an older row of one of its keys, which
    lose that row (see ``_write_partitions``). Rows are first gathered by partition, with
    large ones split, so that a partition gets a few right-sized files rather than one from
    every task.
    """
    partition = _partition_name(CLEAN_PARTITION[dataset])
    path = paths.clean(dataset)
    if only_partitions and partition is not None and files.is_committed(df.sparkSession, path):
        return _write_partitions(df, path, DOMAINS[dataset].key, partition)
    if partition is not None:
        df = df.hint("rebalance", partition)
    rows, observed = _counted(df)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.parquet(path)
    return observed.get["rows"]


def _write_partitions(df: DataFrame, path: str, key: str, partition: str) -> int:
    """Replace the partitions in ``df``, and take rows with its keys out of all others.

    The rows are staged first, so they are made once and what they replace is not read while
    it is replaced. Keys that moved are found by joining the keys alone with key and
    partition of the stored rows; only partitions that hold one are read whole and written
    again. One that would keep no row is removed after the write. If a run dies between,
    running it again finds the same keys. Partitions are days or months, so their names fit
    in the driver.
    """
    spark = df.sparkSession
    staging = fresh_scratch(spark, "staged")
    rows, observed = _counted(df)
    rows.write.parquet(staging)
    staged, stored = spark.read.parquet(staging), spark.read.parquet(path)
    of = F.col(partition).cast("string")
    names = lambda frame: {row[0] for row in frame.select(of).distinct().collect()}
    replaced = names(staged)
    keys = staged.select(key).distinct()
    elsewhere = ~F.coalesce(of, F.lit("")).isin([n or "" for n in replaced])
    held = names(stored.select(key, partition).where(elsewhere).join(keys, key, "left_semi"))
    touched = stored.where(F.coalesce(of, F.lit("")).isin([n or "" for n in held]))
    kept = touched.join(keys, key, "left_anti").select(*staged.columns)
    remaining = names(kept) if held else set()
    whole = staged.unionByName(kept) if remaining else staged
    writer = whole.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    for name in held - remaining:
        files.remove(spark, f"{path}/{partition}={name if name is not None else '__HIVE_DEFAULT_PARTITION__'}")
    files.remove(spark, staging)
    return observed.get["rows"]


def write_mart(df: DataFrame, paths: LakePaths, name: str) -> int:
    """Replace a mart as a whole, so that no month of an earlier run is left behind.

    A partitioned mart keeps its order inside each partition. Sorted as a whole, every
    task would hold, and write a file for, every partition.
    """
    partition = _partition_name(MART_PARTITION.get(name))
    if partition is not None:
        order = [_sort_key(part) for part in MART_ORDER[name].split(", ")]
        df = df.hint("rebalance", partition).sortWithinPartitions(partition, *order)
    rows, observed = _counted(df)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.parquet(paths.mart(name))
    return observed.get["rows"]
