"""Session settings the results depend on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Hash and broadcast joins where a side, as measured while the query runs, is small.
_MEASURED = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}
# Filter one fact by the keys of another before its shuffle. Collecting the keys reads
# that side twice, which pays while it is small; a very large one would fill the filter.
_KEY_FILTERS = {
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64MB",
}


def build_session(app_name: str, **settings: str) -> SparkSession:
    """Session with UTC dates and the join settings above.

    Master, memory and shuffle width belong to spark-submit.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for key, value in {**_MEASURED, **_KEY_FILTERS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset and Spark runs on this machine alone, as in a test, a temporary
    folder stands in. On a cluster executors would each write to their own disk: an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="roost-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_scratch(spark: SparkSession, purpose: str) -> str:
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """The same rows, kept on shared storage, so that a lost executor changes nothing."""
    spark = df.sparkSession
    root = scratch_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint()
