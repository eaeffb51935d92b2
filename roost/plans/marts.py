"""Business tables over the clean layer.

``listings`` has one row per id, as the cleaner leaves it. Facts are added up per
listing before they meet it: that is the shuffle the grouping needs anyway, it moves
numbers instead of names, and a listing with a huge share of the facts shrinks to one
row per map task. Spark then picks the join by the size it sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.functions.money import dollars, total_cents


def review_totals(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("listing_id").agg(
        F.count("id").alias("num_reviews"),
        F.sum("rating").alias("_stars"),
        F.count("rating").alias("_rated"),
    )


def booking_totals(bookings: DataFrame, *by: str) -> DataFrame:
    """The booking funnel, and nights and cents of completed stays, per listing and ``by``."""
    done = F.col("status") == "completed"
    return bookings.groupBy("listing_id", *by).agg(
        F.count("booking_id").alias("total_bookings"),
        F.count_if(done).alias("completed"),
        F.count_if(F.col("status") == "confirmed").alias("confirmed"),
        F.count_if(F.col("status").isin("cancelled", "no_show")).alias("cancelled"),
        F.sum(F.when(done, F.col("nights"))).alias("_nights"),
        total_cents(F.when(done, F.col("amount"))).alias("_cents"),
    )


def _of_listings(listings: DataFrame, totals: DataFrame, *names: str) -> DataFrame:
    dimension = listings.select("id", *names)
    return dimension.join(totals, F.col("id") == F.col("listing_id"))


def _mean(total: Column, rows: Column) -> Column:
    return F.round(F.try_divide(total, rows), 2)


def _share(part: Column, whole: str) -> Column:
    return F.round(F.try_divide(part, F.col(whole)), 4)


# The next five take facts already added up, so that marts can share the totals.


def review_counts_of(listings, totals):
    joined = _of_listings(listings, totals, "name", "neighbourhood")
    return joined.select("id", "name", "neighbourhood", "num_reviews").orderBy(
        F.desc("num_reviews"), "id"
    )


def ratings_of(listings, totals):
    return (
        _of_listings(listings, totals, "name")
        .select("id", "name", _mean(F.col("_stars"), F.col("_rated")).alias("avg_rating"), "num_reviews")
        .orderBy(F.desc("avg_rating"), F.desc("num_reviews"), "id")
    )


def neighbourhood_reviews_of(listings, totals):
    return (
        _of_listings(listings, totals, "neighbourhood")
        .groupBy("neighbourhood")
        .agg(
            F.sum("num_reviews").alias("num_reviews"),
            _mean(F.sum("_stars"), F.sum("_rated")).alias("avg_rating"),
            F.count("id").alias("num_listings"),
        )
        .orderBy(F.desc("num_reviews"), "neighbourhood")
    )


def month_revenue_of(listings, totals):
    """From totals per listing and month."""
    return (
        _of_listings(listings, totals.where("completed > 0"), "name", "neighbourhood")
        .select(
            "id",
            "name",
            "neighbourhood",
            "checkin_month",
            F.col("completed").alias("num_bookings"),
            F.col("_nights").alias("total_nights"),
            dollars(F.col("_cents")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "id", "checkin_month")
    )


def conversion_of(listings, totals):
    """From totals per listing, or per listing and month."""
    funnel = ("total_bookings", "completed", "confirmed", "cancelled")
    if "checkin_month" in totals.columns:
        totals = totals.groupBy("listing_id").agg(*[F.sum(c).alias(c) for c in funnel])
    return (
        _of_listings(listings, totals, "name")
        .select("id", "name", *funnel)
        .withColumn("conversion_rate", _share(F.col("completed") + F.col("confirmed"), "total_bookings"))
        .withColumn("cancellation_rate", _share(F.col("cancelled"), "total_bookings"))
        .orderBy(F.desc("total_bookings"), "id")
    )


def reviews_per_listing(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Number of reviews of each reviewed listing, most first."""
    return review_counts_of(listings, review_totals(reviews))


def avg_rating_per_listing(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean rating of each reviewed listing, best first."""
    return ratings_of(listings, review_totals(reviews))


def reviews_per_neighbourhood(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews, mean rating and reviewed listings of each neighbourhood."""
    return neighbourhood_reviews_of(listings, review_totals(reviews))


def revenue_by_listing_month(listings: DataFrame, bookings: DataFrame) -> DataFrame:
    """Completed bookings, nights and revenue per listing and check-in month."""
    completed = bookings.where(F.col("status") == "completed")
    return month_revenue_of(listings, booking_totals(completed, "checkin_month"))


def booking_conversion(listings: DataFrame, bookings: DataFrame) -> DataFrame:
    """Share of bookings kept and lost per listing; a no-show counts as cancelled."""
    return conversion_of(listings, booking_totals(bookings))


def transaction_success_rates(transactions: DataFrame) -> DataFrame:
    """Outcome of payments per payment method."""
    outcomes = transactions.groupBy("payment_method").agg(
        F.count("txn_id").alias("total_txns"),
        *[
            F.count_if(F.col("status") == outcome).alias(outcome)
            for outcome in ("succeeded", "failed", "refunded")
        ],
        dollars(
            total_cents(F.when(F.col("status") == "succeeded", F.col("amount")).otherwise(0.0))
        ).alias("settled_amount"),
    )
    return outcomes.withColumn("success_rate", _share(F.col("succeeded"), "total_txns")).orderBy(
        F.desc("total_txns"), "payment_method"
    )
