"""The pipeline: land, verify, clean, gate, publish."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from roost import files
from roost.operators.cleaning import DOMAINS
from roost.operators.quality import GATES, DataQualityError, QualityReport
from roost.paths import DATASETS, LakePaths
from roost.plans import marts
from roost.schemas import MART_ORDER
from roost.session import fresh_scratch
from roost.sinks.tables import land, write_clean, write_mart
from roost.sources.raw import count_landed, raw_if_landed
from roost.sources.stored import read_clean, read_clean_tables, read_mart


@dataclass
class Outcome:
    """Rows per dataset or mart after each step."""

    landed: dict[str, int] = field(default_factory=dict)
    clean: dict[str, int] = field(default_factory=dict)
    gates: dict[str, QualityReport] = field(default_factory=dict)
    marts: dict[str, int] = field(default_factory=dict)

    def as_text(self) -> str:
        steps = {
            "landed": self.landed,
            "clean": self.clean,
            "passed the gate": {name: report.row_count for name, report in self.gates.items()},
            "mart": self.marts,
        }
        return "\n".join(
            f"{step} {name}: {rows} rows" for step, counts in steps.items() for name, rows in counts.items()
        )


def land_and_verify(
    spark: SparkSession, paths: LakePaths, raw: Mapping[str, DataFrame], ingest_date: str
) -> dict[str, int]:
    """Land every dataset, then count the stored lines again."""
    landed = {}
    for dataset, records in raw.items():
        landed[dataset] = land(records, paths, dataset, ingest_date)
        per_date = count_landed(spark, paths, dataset).where(f"ingest_date = DATE '{ingest_date}'")
        stored = sum(row["records"] for row in per_date.collect())
        if stored != landed[dataset]:
            raise DataQualityError(f"{dataset}: {stored} records stored, {landed[dataset]} landed")
    return landed


def clean_all(spark: SparkSession, paths: LakePaths) -> dict[str, int]:
    """Clean each dataset that was landed; listings and reviews have to be there."""
    counts = {}
    for dataset in DATASETS:
        raw = raw_if_landed(spark, paths, dataset)
        if raw is not None:
            counts[dataset] = write_clean(DOMAINS[dataset].clean(raw), paths, dataset)
        elif dataset in ("listings", "reviews"):
            raise FileNotFoundError(paths.raw(dataset))
    return counts


def gate_all(
    spark: SparkSession, paths: LakePaths, datasets: Iterable[str]
) -> dict[str, QualityReport]:
    return {d: GATES[d].check(read_clean(spark, paths, d)) for d in datasets}


def publish_all(spark: SparkSession, paths: LakePaths) -> dict[str, int]:
    """Write every mart whose clean tables exist.

    Facts are read once: each is added up per listing, the totals are kept for the two
    or three marts that share them, and removed afterwards. They are kept as scratch files:
    those are cut by size, while cached rows would stay in as many parts as a shuffle may
    have, each of which writes as many again in the shuffle that follows.
    """
    tables = read_clean_tables(spark, paths)
    listings, counts = tables["listings"], {}

    def publish(totals: DataFrame, **builders) -> None:
        kept = fresh_scratch(spark, "totals")
        try:
            totals.write.parquet(kept)
            stored = spark.read.schema(totals.schema).parquet(kept)
            for name, build in builders.items():
                counts[name] = write_mart(build(listings, stored), paths, name)
        finally:
            files.remove(spark, kept)

    publish(
        marts.review_totals(tables["reviews"]),
        reviews_per_listing=marts.review_counts_of,
        avg_rating_per_listing=marts.ratings_of,
        reviews_per_neighbourhood=marts.neighbourhood_reviews_of,
    )
    if "bookings" in tables:
        publish(
            marts.booking_totals(tables["bookings"], "checkin_month"),
            revenue_by_listing_month=marts.month_revenue_of,
            booking_conversion=marts.conversion_of,
        )
    if "transactions" in tables:
        rates = marts.transaction_success_rates(tables["transactions"])
        counts["transaction_success_rates"] = write_mart(rates, paths, "transaction_success_rates")
    return counts


def run(
    spark: SparkSession,
    paths: LakePaths,
    raw: Mapping[str, DataFrame] | None = None,
    ingest_date: str | None = None,
    gated: Iterable[str] = ("reviews", "bookings", "transactions"),
) -> Outcome:
    """Everything in order. Without ``raw`` it starts from what was landed before.

    A table that fails its gate raises, and no mart is written. Counting distinct keys
    shuffles the whole table, so only the ``gated`` ones are checked.
    """
    outcome = Outcome()
    if raw is not None:
        outcome.landed = land_and_verify(spark, paths, raw, ingest_date)
    outcome.clean = clean_all(spark, paths)
    outcome.gates = gate_all(spark, paths, [d for d in gated if d in outcome.clean])
    outcome.marts = publish_all(spark, paths)
    return outcome


def show_samples(spark: SparkSession, paths: LakePaths, names: Iterable[str], rows: int) -> None:
    """Print the first rows of marts that were written, in their order."""
    for name in names:
        print(name)
        mart = read_mart(spark, paths, name)
        spark.sql(f"SELECT * FROM {{mart}} ORDER BY {MART_ORDER[name]}", mart=mart).show(
            rows, truncate=False
        )
