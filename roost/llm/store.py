"""Intermediate tables in the shared folder, so that a lost executor costs nothing done before."""

from __future__ import annotations

from pyspark.sql import DataFrame

from roost.session import fresh_scratch


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, written once as Parquet and read back."""
    path = fresh_scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
