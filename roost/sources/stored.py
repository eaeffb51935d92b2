"""Reading stored layouts back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from roost.files import is_committed
from roost.paths import DATASETS, LakePaths
from roost.plans.marketplace import Marketplace
from roost.schemas import CLEAN, CLEAN_PARTITION, MART_PARTITION, MARTS


def _read(spark: SparkSession, path: str, columns: str, partition: str | None) -> DataFrame:
    """A table by its declared columns: no file is opened to learn them, and a table that
    has no rows, hence no files, can be read as well."""
    every = f"{columns}, {partition}" if partition else columns
    return spark.read.schema(every).parquet(path)


def read_clean(spark: SparkSession, paths: LakePaths, dataset: str) -> DataFrame:
    return _read(spark, paths.clean(dataset), CLEAN[dataset], CLEAN_PARTITION[dataset])


def read_mart(spark: SparkSession, paths: LakePaths, name: str) -> DataFrame:
    return _read(spark, paths.mart(name), MARTS[name], MART_PARTITION.get(name))


def read_clean_tables(spark: SparkSession, paths: LakePaths) -> dict[str, DataFrame]:
    """The clean tables that were written to the end."""
    written = [d for d in DATASETS if is_committed(spark, paths.clean(d))]
    return {dataset: read_clean(spark, paths, dataset) for dataset in written}


def load_layout(spark: SparkSession, base: str, start: date, *, by_month: bool) -> Marketplace:
    """The tables of one layout; the plain one has no summary and no month partitions."""
    base = base.rstrip("/")
    return Marketplace(
        listings=spark.read.parquet(f"{base}/listings"),
        bookings=spark.read.parquet(f"{base}/bookings"),
        reviews=spark.read.parquet(f"{base}/reviews"),
        payments=spark.read.parquet(f"{base}/transactions"),
        start=start,
        summary=spark.read.parquet(f"{base}/summary") if is_committed(spark, f"{base}/summary") else None,
        by_month=by_month,
    )
