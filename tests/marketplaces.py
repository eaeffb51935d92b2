"""A small marketplace from literal rows, with a listing on each payment."""

from datetime import date

from roost.plans.marketplace import Marketplace

START = date(2023, 1, 1)


def small_marketplace(spark, listings=(), bookings=(), payments=(), reviews=(), **options):
    """listings (id, area, room); bookings (id, listing, day, nights, status);
    payments (id, booking, listing, day, amount, status); reviews (id, listing, day, rating)."""
    listing_table = spark.createDataFrame(
        list(listings), "listing_id BIGINT, neighbourhood STRING, room_type STRING"
    ).selectExpr("*", "50.0D AS price", "1 AS minimum_nights")
    booking_table = spark.createDataFrame(
        list(bookings), "booking_id BIGINT, listing_id BIGINT, checkin_date DATE, nights INT, status STRING"
    ).selectExpr(
        "*", "1L AS guest_id", "100.0D AS amount", "date_format(checkin_date, 'yyyy-MM') AS checkin_month"
    )
    payment_table = spark.createDataFrame(
        list(payments),
        "txn_id BIGINT, booking_id BIGINT, listing_id BIGINT, txn_date DATE, amount DOUBLE, status STRING",
    ).selectExpr(
        "*", "'USD' AS currency", "'card' AS payment_method", "date_format(txn_date, 'yyyy-MM') AS txn_month"
    )
    review_table = spark.createDataFrame(
        list(reviews), "review_id BIGINT, listing_id BIGINT, review_date DATE, rating INT"
    ).selectExpr("*", "1L AS reviewer_id", "date_format(review_date, 'yyyy-MM') AS review_month")
    return Marketplace(listing_table, booking_table, review_table, payment_table, START, **options)
