"""A note beside a layout of what it was built from, so that timings are of what was asked."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from roost.files import is_committed


def save_manifest(spark: SparkSession, path: str, content: dict) -> None:
    line = spark.createDataFrame([(json.dumps(content, sort_keys=True),)], "value STRING")
    line.coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """What was noted, or None where nothing was written to the end."""
    if not is_committed(spark, path):
        return None
    return json.loads(spark.read.text(path).first()[0])
