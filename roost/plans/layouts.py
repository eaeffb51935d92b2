"""Building the layouts the workloads are compared on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from roost.plans import star
from roost.plans.marketplace import Marketplace
from roost.sinks.layout import (
    TUNED,
    buckets_for,
    is_even,
    rows_per_key,
    write_bucketed,
    write_csv,
    write_plain,
    write_tuned,
)
from roost.sources.stored import load_layout
from roost.sources.synthetic import START

# Facts that are joined with each other, by ``booking_id``.
BUCKETED = ("transactions", "bookings")


def star_tables(lake: Marketplace) -> dict[str, DataFrame]:
    return {
        "transactions": star.fact_transactions(lake),
        "bookings": star.fact_bookings(lake),
        "reviews": star.fact_reviews(lake),
        "listings": star.dim_listing(lake),
    }


def write_tuned_layout(
    spark: SparkSession,
    base: str,
    tables: Mapping[str, DataFrame],
    counted: Mapping[str, DataFrame] | None = None,
) -> None:
    """Write the star, then the summary from the pruned files just written.

    ``counted`` names tables whose days stand for those of a table that costs more to read,
    such as payments before they are joined to their listings.
    """
    base = base.rstrip("/")
    for dataset, df in tables.items():
        days = (counted or {}).get(dataset)
        counts = rows_per_key(days, TUNED[dataset]) if days is not None else None
        write_tuned(df, f"{base}/{dataset}", TUNED[dataset], counts)
    lake = load_layout(spark, base, START, by_month=True)
    write_tuned(
        star.summary_listing_month(lake),
        f"{base}/summary",
        TUNED["summary"],
        # As many payments as a month has, it has at most so many listings.
        rows_per_key(lake.payments, TUNED["summary"]),
    )


def facts_of(lake: Marketplace) -> dict[str, DataFrame]:
    """The facts as they are stored, for counting their days."""
    return {"transactions": lake.payments, "bookings": lake.bookings, "reviews": lake.reviews}


def write_bucketed_layout(
    spark: SparkSession, base: str, database: str, lake: Marketplace, buckets: int
) -> bool:
    """Payments and bookings cut by ``booking_id``, as tables of ``database``.

    ``buckets`` is their least number. Both tables get as many as the larger one needs, so
    that a task's bucket does not grow with the tables and no shuffle lies between them.

    Where one booking has so many payments that its bucket would be a task's burden, nothing
    is written and the answer is False: joins by shuffle, which Spark splits at run time,
    then stay the better way.
    """
    tables = star_tables(lake)
    buckets = buckets_for(max(lake.payments.count(), lake.bookings.count()), buckets)
    if not all(is_even(df, "booking_id", buckets) for df in (lake.payments, lake.bookings)):
        return False
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for dataset in BUCKETED:
        write_bucketed(
            tables[dataset], f"{database}.{dataset}", f"{base}/{dataset}", TUNED[dataset], "booking_id", buckets
        )
    return True


def with_buckets(spark: SparkSession, lake: Marketplace, database: str) -> Marketplace:
    """The layout with payments and bookings read from their buckets."""
    return replace(
        lake,
        payments=spark.table(f"{database}.transactions"),
        bookings=spark.table(f"{database}.bookings"),
        by_month=True,
    )


def write_plain_layout(
    base: str, tables: Mapping[str, DataFrame], files: Mapping[str, int] | None = None
) -> None:
    for dataset, df in tables.items():
        write_plain(df, f"{base.rstrip('/')}/{dataset}", (files or {}).get(dataset))


def write_csv_copy(base: str, tables: Mapping[str, DataFrame]) -> None:
    write_csv(tables["transactions"], f"{base.rstrip('/')}/csv_transactions")
