"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before kept and is written as Parquet
before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roost.llm import jaccard, mixing, packing, pii, quality
from roost.session import fresh_scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return quality.clean_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return jaccard.first_of_each_group(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redact_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once for each pass that the mix takes."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("personal_data", redact),
    ("mix", mix_sources),
    ("pack", pack),
]

# Shingle components, trained spans and tokens have no SQL; tests check them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
