"""What lies at a path, on any filesystem Spark reaches."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

COMMITTED = "_SUCCESS"  # written by Spark when a job has written all its files
UNFINISHED = "_temporary"  # there while a job writes, and after one that died


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the end. A folder that is half written was not."""
    return exists(spark, f"{path.rstrip('/')}/{COMMITTED}")


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders directly below a path, none if there is no such path."""
    files, place = _at(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().toString() for s in files.listStatus(place) if s.isDirectory())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its filesystem, as a catalog keeps it."""
    files, place = _at(spark, path)
    return files.makeQualified(place).toString()


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)
