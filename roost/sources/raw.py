"""Reading what was landed: raw records, and how many there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roost import files
from roost.paths import LakePaths
from roost.schemas import RAW


def read_raw(
    spark: SparkSession, paths: LakePaths, dataset: str, ingest_date: str | None = None
) -> DataFrame:
    """Raw records of every ingest date, or of one.

    The schema is given, so nothing is scanned to infer it. Folders are walked without
    reading their names as columns: the ingest date is not part of a record.
    """
    reader = spark.read.schema(RAW[dataset]).option("recursiveFileLookup", "true")
    if ingest_date:
        return reader.json(paths.landed(dataset, ingest_date))
    return reader.json(landed_folders(spark, paths, dataset) or [paths.raw(dataset)])


def landed_folders(spark: SparkSession, paths: LakePaths, dataset: str) -> list[str]:
    """Folders of the ingest dates, without those whose landing never came to an end."""
    dates = files.folders(spark, paths.raw(dataset))
    return [d for d in dates if not files.exists(spark, f"{d}/{files.UNFINISHED}")]


def count_landed(spark: SparkSession, paths: LakePaths, dataset: str) -> DataFrame:
    """Records per ingest date, blank lines left out."""
    lines = spark.read.text(paths.raw(dataset)).where(F.col("value").rlike(r"\S"))
    return (
        lines.groupBy("ingest_date")
        .agg(F.count(F.lit(1)).alias("records"))
        .select(F.lit(dataset).alias("dataset"), "ingest_date", "records")
    )


def raw_if_landed(spark: SparkSession, paths: LakePaths, dataset: str) -> DataFrame | None:
    """Raw records, or None where no date has been landed to the end."""
    return read_raw(spark, paths, dataset) if landed_folders(spark, paths, dataset) else None
