"""The operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roost.llm import (
    alignment,
    divergence,
    fingerprints,
    jaccard,
    language,
    license_scan,
    mixing,
    packing,
    pii,
    quality,
    token_counts,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _in_fold(fold: int, folds: int) -> Column:
    """Whether an id falls in a fold; a null id falls in none."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(code % folds == fold, F.lit(False))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(_table(spark, sf_dir, "documents"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixture(_table(spark, sf_dir, "documents"))
    first = lambda name: F.get(name, F.lit(0))
    return mix.select(
        "*", F.round(first("positions"), 6).alias("first_position"), first("places").alias("first_place")
    ).drop("positions", "places")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = _in_fold(0, 5)
    model = toxicity.train(docs, labels.filter(~held_out).select("doc_id", "toxic"))
    return toxicity.score(docs, model, held_out)


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents")).drop("clean_text")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find_personal_data(docs, pii.train(docs))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


RULES = [
    url_filter.rule("allow", "org/"),
    url_filter.rule("block", "example.org/es/"),
    url_filter.rule("block", "example.org/en/1"),
    url_filter.rule("allow", "com/fr/"),
    url_filter.rule("block", "com/de/"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), RULES, url_filter.train()).drop("probability")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _in_fold(1, 3)
    return language.identify(docs, language.train(docs.filter(~held_out)), held_out)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(_table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_ngram_jaccard,
        op2_source_mix,
        op3_toxicity,
        op4_fingerprints,
        op5_quality_rules,
        op6_personal_data,
        op7_best_fit_packing,
        op8_url_filter,
        op9_language,
        op10_token_counts,
        op11_source_divergence,
        op12_tokenizer_alignment,
        op13_license_scan,
    )
}
