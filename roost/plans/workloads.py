"""The 22 analytic workloads over one layout of the marketplace.

Each takes a `Marketplace` and returns a lazy DataFrame. Seven of them read the
summary of revenue by listing and month where the layout has one, and the payments
where it has not; the answer is the same.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.functions.money import cents, dollars, total_cents
from roost.operators import windows
from roost.plans.marketplace import Marketplace

MONTH, QUARTER = 30, 90


@dataclass(frozen=True)
class Workload:
    key: str
    title: str
    technique: str
    plan: Callable[[Marketplace], DataFrame]


WORKLOADS: dict[str, Workload] = {}


def _workload(key: str, title: str, technique: str):
    def register(plan):
        WORKLOADS[key] = Workload(key, title, technique, plan)
        return plan

    return register


def _settled(payments: DataFrame) -> DataFrame:
    return payments.where(F.col("status") == "succeeded")


def _rows() -> Column:
    return F.count(F.lit(1))


def _in_dollars(df: DataFrame, *keys: str, revenue: str = "revenue", **more: str) -> DataFrame:
    """Keys, the total as dollars, and further columns as new name = old name."""
    return df.select(
        *keys,
        dollars(F.col("cents")).alias(revenue),
        *[F.col(old).alias(new) for new, old in more.items()],
    )


def _revenue(lake: Marketplace, *, listing: tuple[str, ...] = (), month: bool = False) -> DataFrame:
    """Succeeded revenue as ``cents`` and its payments as ``n``, summary first."""
    by = ("txn_month",) if month else ()
    if lake.summary is not None and month and listing == ("listing_id",):
        # the summary's own grain: nothing to add up
        return lake.summary.select(
            *by, *listing, cents(F.col("revenue")).alias("cents"), F.col("txn_count").alias("n")
        )
    if lake.summary is not None:
        return lake.summary.groupBy(*by, *listing).agg(
            total_cents("revenue").alias("cents"), F.sum("txn_count").alias("n")
        )
    paid = _settled(lake.payments)
    if listing:
        return lake.payment_totals(paid, listing=listing, by=by)
    return paid.groupBy(*by).agg(total_cents().alias("cents"), _rows().alias("n"))


@_workload("q01_date_range_revenue", "Payment totals by status, 30 days", "date range")
def date_range_revenue(lake):
    return (
        lake.payments_in(lake.span(400, MONTH))
        .groupBy("status")
        .agg(dollars(total_cents()).alias("total"), _rows().alias("n"))
    )


@_workload("q02_method_success", "Succeeded payments by method", "column pruning")
def method_success(lake):
    totals = _settled(lake.payments).groupBy("payment_method").agg(
        dollars(total_cents()).alias("total"), _rows().alias("n")
    )
    return totals.select("payment_method", "total", (F.col("total") / F.col("n")).alias("avg_amt"))


@_workload("q03_single_day", "Payment totals by currency, one day", "date range")
def single_day(lake):
    return (
        lake.payments_in(lake.span(500, 1))
        .groupBy("currency")
        .agg(dollars(total_cents()).alias("total"))
    )


@_workload("q04_txn_listing_join", "Revenue by neighbourhood, 30 days", "join")
def revenue_by_neighbourhood(lake):
    paid = _settled(lake.payments_in(lake.span(200, MONTH)))
    return _in_dollars(lake.payment_totals(paid, listing=["neighbourhood"]), "neighbourhood")


@_workload("q05_txn_booking_join", "Revenue of completed stays by nights, 30 days", "fact join")
def revenue_by_nights(lake):
    paid = _settled(lake.payments_in(lake.span(250, MONTH))).select("booking_id", "amount")
    stays = lake.bookings.where(F.col("status") == "completed").select("booking_id", "nights")
    return (
        paid.join(stays, "booking_id")
        .groupBy("nights")
        .agg(dollars(total_cents()).alias("revenue"), _rows().alias("n"))
    )


@_workload("q06_three_way_join", "Revenue by room type through bookings, 90 days", "fact join")
def revenue_by_room_type(lake):
    paid = _settled(lake.payments_in(lake.span(300, QUARTER)))
    totals = lake.payment_totals(paid, listing=["room_type"], via_booking=True)
    return _in_dollars(totals, "room_type")


@_workload("q07_review_listing_join", "Rating by neighbourhood, 30 days", "join")
def rating_by_neighbourhood(lake):
    per_listing = (
        lake.reviews_in(lake.span(150, MONTH))
        .groupBy("listing_id")
        .agg(F.sum("rating").alias("stars"), _rows().alias("n"))
    )
    n = F.sum("n")
    return (
        per_listing.join(lake.listings.select("listing_id", "neighbourhood"), "listing_id")
        .groupBy("neighbourhood")
        .agg((F.sum("stars") / n).alias("avg_rating"), n.alias("n"))
    )


@_workload("q08_bookings_by_month", "Booking value by month and status, 90 days", "date range")
def bookings_by_month(lake):
    return (
        lake.bookings_in(lake.span(120, QUARTER))
        .groupBy("checkin_month", "status")
        .agg(dollars(total_cents()).alias("gmv"), _rows().alias("n"))
    )


@_workload("q09_running_total", "Running total of monthly revenue", "window, summary")
def running_total(lake):
    monthly = _revenue(lake, month=True)
    return monthly.select(
        "txn_month",
        dollars(F.col("cents")).alias("revenue"),
        dollars(windows.running("cents", "txn_month")).alias("running_total"),
    )


@_workload("q10_topn_per_month", "Top three listings per month, ties included", "window, summary")
def top_listings_per_month(lake):
    totals = _revenue(lake, listing=("listing_id",), month=True)
    top = windows.top_per_group(totals, "txn_month", "cents", 3, "rk")
    return _in_dollars(top, "txn_month", "listing_id", rk="rk")


@_workload("q11_moving_avg_3m", "Average revenue of three months", "window, summary")
def moving_average_of_months(lake):
    total, months = windows.trailing_sum_and_rows("cents", "txn_month", 3)
    return _revenue(lake, month=True).select(
        "txn_month",
        dollars(F.col("cents")).alias("revenue"),
        (dollars(total) / months).alias("moving_avg_3m"),
    )


@_workload("q12_nbhd_share", "Listing's share of its neighbourhood", "window, summary")
def share_of_neighbourhood(lake):
    """The group total comes from its own small aggregate instead of a window.

    A window would gather each neighbourhood, however large, in one task. The totals
    have a row per neighbourhood; Spark broadcasts them if it finds them small.
    """
    per_listing = _revenue(lake, listing=("neighbourhood", "listing_id"))
    totals = per_listing.groupBy(F.col("neighbourhood").alias("_area")).agg(
        F.sum("cents").alias("all_cents")
    )
    return (
        per_listing.join(totals, F.col("neighbourhood").eqNullSafe(F.col("_area")))
        .select(
            "neighbourhood",
            "listing_id",
            dollars(F.col("cents")).alias("revenue"),
            dollars(F.col("all_cents")).alias("nbhd_total"),
        )
        .withColumn("share", F.try_divide("revenue", "nbhd_total"))
    )


@_workload("q13_rank_nbhd", "Neighbourhoods ranked by revenue, 90 days", "window, join")
def neighbourhoods_ranked(lake):
    paid = _settled(lake.payments_in(lake.span(400, QUARTER)))
    totals = lake.payment_totals(paid, listing=["neighbourhood"])
    ranked = windows.global_rank(totals, "cents", "rank")
    return _in_dollars(ranked, "neighbourhood", rank="rank")


@_workload("q14_mom_delta", "Revenue against the month before", "window, summary")
def change_by_month(lake):
    monthly = _revenue(lake, month=True).withColumn("before", windows.previous("cents", "txn_month"))
    return monthly.select(
        "txn_month",
        dollars(F.col("cents")).alias("revenue"),
        dollars(F.col("before")).alias("prev"),
        dollars(F.col("cents") - F.col("before")).alias("mom_delta"),
    )


@_workload("q15_pareto_share", "Cumulative share of revenue by listing", "window, summary")
def pareto(lake):
    totals = _revenue(lake, listing=("listing_id",)).select("listing_id", "cents")
    ranked = windows.cumulative_share(totals, "cents", "listing_id")
    return (
        _in_dollars(ranked, "listing_id", cum="cum", grand="grand")
        .withColumn("cum_rev", dollars(F.col("cum")))
        .withColumn("grand_total", dollars(F.col("grand")))
        .withColumn("cum_share", F.try_divide("cum_rev", "grand_total"))
        .drop("cum", "grand")
    )


@_workload("q16_success_rate", "Payment success by method, 90 days", "conditional aggregate")
def success_rate(lake):
    return (
        lake.payments_in(lake.span(200, QUARTER))
        .groupBy("payment_method")
        .agg(
            (F.count_if(F.col("status") == "succeeded") / _rows()).alias("success_rate"),
            _rows().alias("attempts"),
        )
    )


@_workload("q17_conversion", "Paid against booked per listing, 30 days", "fact join")
def conversion(lake):
    """Bookings of the month are the small side of an inner join, free to be broadcast or
    hashed; a left join from them to all payments would not allow that."""
    booked = lake.bookings_in(lake.span(350, MONTH)).select("booking_id", "listing_id")
    paid = (
        _settled(lake.payments)
        .select("booking_id")
        .join(booked, "booking_id")
        .groupBy("listing_id")
        .agg(_rows().alias("paid"))
    )
    return (
        booked.groupBy("listing_id")
        .agg(_rows().alias("bookings"))
        .join(paid, "listing_id", "left")
        .withColumn("conversion", F.col("paid") / F.col("bookings"))
    )


@_workload("q18_reviews_vs_revenue", "Rating and revenue per listing, 90 days", "fact join")
def rating_and_revenue(lake):
    quarter = lake.span(180, QUARTER)
    rated = (
        lake.reviews_in(quarter)
        .groupBy("listing_id")
        .agg((F.sum("rating") / _rows()).alias("avg_rating"), _rows().alias("n_reviews"))
    )
    paid = _settled(lake.payments_in(quarter))
    totals = lake.payment_totals(paid, listing=["listing_id"])
    return rated.join(_in_dollars(totals, "listing_id"), "listing_id")


@_workload("q19_wide_scan", "Payment totals by status, all rows", "column pruning")
def wide_scan(lake):
    return lake.payments.groupBy("status").agg(
        dollars(total_cents()).alias("total"), _rows().alias("n")
    )


@_workload("q20_avg_daily_rev", "Average daily revenue by neighbourhood, 30 days", "join")
def average_day_by_neighbourhood(lake):
    paid = _settled(lake.payments_in(lake.span(450, MONTH)))
    daily = lake.payment_totals(paid, listing=["neighbourhood"], by=["txn_date"])
    return daily.groupBy("neighbourhood").agg(
        (dollars(F.sum("cents")) / _rows()).alias("avg_daily_rev")
    )


@_workload("q21_gold_preagg", "Revenue by neighbourhood, all time", "summary")
def neighbourhood_revenue(lake):
    return _in_dollars(_revenue(lake, listing=("neighbourhood",)), "neighbourhood", txns="n")


@_workload("q22_moving_avg_7d", "Average revenue of seven days, 90 days", "window")
def moving_average_of_days(lake):
    paid = _settled(lake.payments_in(lake.span(260, QUARTER)))
    daily = paid.groupBy("txn_date").agg(total_cents().alias("cents"))
    total, days = windows.trailing_sum_and_rows("cents", "txn_date", 7)
    return daily.select(
        "txn_date",
        dollars(F.col("cents")).alias("day_rev"),
        (dollars(total) / days).alias("moving_avg_7d"),
    )
