"""The marketplace domains over TPC-H-like tables.

`customer`, `orders`, `lineitem` and `events` stand for listings, bookings, payments
and reviews. Codes become the marketplace's words, and the `raw_*` functions add
defects and repeated rows for the cleaners to find.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roost.plans.marketplace import Marketplace

START = date(1997, 1, 1)
_CURRENCIES = ("USD", "EUR", "GBP", "AUD")
_METHODS = ("card", "paypal", "apple_pay", "google_pay", "bank_transfer")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _word(code: Column, words: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), (code % len(words) + 1).cast("int"))


def _month(day: Column) -> Column:
    return F.substring(day.cast("string"), 1, 7)


def _booking_status() -> Column:
    undone = F.when(F.col("o_orderkey") % 2 == 0, "cancelled").otherwise("no_show")
    return (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "confirmed")
        .otherwise(undone)
    )


def _payment_status() -> Column:
    return (
        F.when(F.col("l_returnflag") == "N", "succeeded")
        .when(F.col("l_returnflag") == "R", "refunded")
        .otherwise("failed")
    )


def _nights() -> Column:
    return (F.col("o_orderkey") % 14 + 1).cast("int")


def _review_day() -> Column:
    return F.date_add(F.lit(START), ((F.col("event_id") * 353) % 730).cast("int"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers = _table(spark, sf_dir, "customer")
    return customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("bigint").alias("host_id"),
        F.col("n_name").alias("neighbourhood"),
        F.col("c_mktsegment").alias("room_type"),
        F.col("c_acctbal").alias("price"),
        (F.col("c_custkey") % 7 + 1).cast("int").alias("minimum_nights"),
    )


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkin = F.col("o_orderdate").cast("date")
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("booking_id"),
        F.col("o_custkey").alias("listing_id"),
        (F.col("o_orderkey") % 900000 + 100000).alias("guest_id"),
        checkin.alias("checkin_date"),
        F.date_add(checkin, _nights()).alias("checkout_date"),
        _nights().alias("nights"),
        F.col("o_totalprice").alias("amount"),
        _booking_status().alias("status"),
        _month(checkin).alias("checkin_month"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments as the lake stores them: the listing is the booking's."""
    day = F.col("l_shipdate").cast("date")
    return _table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("txn_id"),
        F.col("l_orderkey").alias("booking_id"),
        F.col("l_shipdate").alias("ts"),
        day.alias("txn_date"),
        _month(day).alias("txn_month"),
        F.col("l_extendedprice").alias("amount"),
        _payment_status().alias("status"),
        _word(F.col("l_suppkey"), _CURRENCIES).alias("currency"),
        _word(F.col("l_partkey"), _METHODS).alias("payment_method"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("listing_id"),
        _review_day().alias("review_date"),
        (F.col("event_id") % 2000000 + 1000000).alias("reviewer_id"),
        F.concat(F.lit("guest-"), (F.col("event_id") % 10000).cast("string")).alias("reviewer_name"),
        (F.col("event_id") % 5 + 1).cast("int").alias("rating"),
        F.col("event_type").alias("comments"),
        _month(_review_day()).alias("review_month"),
    )


def marketplace(spark: SparkSession, sf_dir: str) -> Marketplace:
    return Marketplace(
        listings=listings(spark, sf_dir).withColumnRenamed("id", "listing_id"),
        bookings=bookings(spark, sf_dir),
        reviews=reviews(spark, sf_dir),
        payments=payments(spark, sf_dir),
        start=START,
    )


def _spoiled(key: str, remainder: int, bad: str | None, good: Column) -> Column:
    return F.when(F.col(key) % 61 == remainder, F.lit(bad)).otherwise(good)


def _some_twice(df: DataFrame, key: str) -> DataFrame:
    """Every row, and those with a key divisible by 20 once more."""
    copies = F.when(F.col(key) % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _some_twice(listings(spark, sf_dir), "id")
    return rows.select(
        "id",
        _spoiled("id", 1, "  ", F.col("name")).alias("name"),
        "host_id",
        "neighbourhood",
        "room_type",
        _spoiled("id", 2, "n/a", F.col("price").cast("string")).alias("price"),
        _spoiled("id", 3, "x", F.col("minimum_nights").cast("string")).alias("minimum_nights"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _some_twice(reviews(spark, sf_dir), "id")
    return rows.select(
        "id",
        _spoiled("id", 1, None, F.col("listing_id")).alias("listing_id"),
        _spoiled("id", 2, "not-a-date", F.col("review_date").cast("string")).alias("date"),
        _spoiled("id", 3, None, F.col("reviewer_id")).alias("reviewer_id"),
        "reviewer_name",
        _spoiled("id", 4, "0", F.col("rating").cast("string")).alias("rating"),
        _spoiled("id", 5, "   ", F.col("comments")).alias("comments"),
    )


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _some_twice(bookings(spark, sf_dir), "booking_id")
    key = "booking_id"
    return rows.select(
        key,
        _spoiled(key, 1, None, F.col("listing_id")).alias("listing_id"),
        _spoiled(key, 3, None, F.col("guest_id")).alias("guest_id"),
        _spoiled(key, 2, "not-a-date", F.col("checkin_date").cast("string")).alias("checkin_date"),
        F.col("checkout_date").cast("string").alias("checkout_date"),
        _spoiled(key, 4, "0", F.col("nights").cast("string")).alias("nights"),
        _spoiled(key, 5, "-1.0", F.col("amount").cast("string")).alias("amount"),
        "status",
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment ids already repeat with different contents, so no rows are added."""
    key = "booking_id"
    return payments(spark, sf_dir).select(
        "txn_id",
        _spoiled(key, 1, None, F.col(key)).alias("booking_id"),
        _spoiled(key, 2, "not-a-timestamp", F.col("ts").cast("string")).alias("ts"),
        _spoiled(key, 3, None, F.col("amount").cast("string")).alias("amount"),
        _spoiled(key, 4, "  ", F.col("currency")).alias("currency"),
        _spoiled(key, 5, "", F.col("payment_method")).alias("payment_method"),
        "status",
    )


RAW = {
    "listings": raw_listings,
    "reviews": raw_reviews,
    "bookings": raw_bookings,
    "transactions": raw_transactions,
}
