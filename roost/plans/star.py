"""Star schema: one listing dimension, three facts, one summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.functions.money import dollars
from roost.plans.marketplace import Marketplace


def dim_listing(lake: Marketplace) -> DataFrame:
    return lake.listings.select(
        "listing_id", "neighbourhood", "room_type", "price", "minimum_nights"
    )


def fact_transactions(lake: Marketplace) -> DataFrame:
    """Payments with their listing, taken from the booking where it is not stored.

    The join has nothing between its shuffles and itself, so Spark can split a booking
    with very many payments at run time.
    """
    payments = lake.payments
    if "listing_id" not in payments.columns:
        payments = payments.join(lake.bookings.select("booking_id", "listing_id"), "booking_id")
    return payments.select(
        "txn_id", "booking_id", "listing_id", "txn_date", "txn_month",
        "amount", "status", "currency", "payment_method",
    )


def fact_bookings(lake: Marketplace) -> DataFrame:
    return lake.bookings.select(
        "booking_id", "listing_id", "guest_id", "checkin_date", "checkin_month",
        "nights", "amount", "status",
    )


def fact_reviews(lake: Marketplace) -> DataFrame:
    reviews = lake.reviews
    if "review_id" not in reviews.columns:
        reviews = reviews.withColumnRenamed("id", "review_id")
    return reviews.select(
        "review_id", "listing_id", "reviewer_id", "review_date", "review_month", "rating"
    )


def summary_listing_month(lake: Marketplace) -> DataFrame:
    """Succeeded revenue per listing and month, with the listing's attributes."""
    paid = lake.payments.where(F.col("status") == "succeeded")
    totals = lake.payment_totals(
        paid, listing=["listing_id", "neighbourhood", "room_type"], by=["txn_month"]
    )
    revenue = dollars(F.col("cents"))
    return totals.select(
        "listing_id",
        "txn_month",
        revenue.alias("revenue"),
        F.col("n").alias("txn_count"),
        (revenue / F.col("n")).alias("avg_ticket"),
        "neighbourhood",
        "room_type",
    )
