"""The four domains as the workloads see them, and the roll-ups they share."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.functions.calendar import DayRange
from roost.functions.money import joined, split, total_cents
from roost.operators.pruning import in_days


@dataclass(frozen=True)
class Marketplace:
    """Tables of one layout.

    ``listings`` has one row per ``listing_id`` and ``bookings`` one per
    ``booking_id``. ``payments`` may carry its ``listing_id``; where it does not, the
    listing is found through the booking, and only for queries that ask for it.
    ``summary`` is succeeded revenue per listing and month, if it was built.
    ``by_month`` says that the facts are partitioned by their month column.
    """

    listings: DataFrame
    bookings: DataFrame
    reviews: DataFrame
    payments: DataFrame
    start: date
    summary: DataFrame | None = None
    by_month: bool = False

    def span(self, offset: int, length: int) -> DayRange:
        return DayRange.after(self.start, offset, length)

    def payments_in(self, days: DayRange) -> DataFrame:
        return in_days(self.payments, "txn_date", days, "txn_month" if self.by_month else None)

    def bookings_in(self, days: DayRange) -> DataFrame:
        return in_days(self.bookings, "checkin_date", days, "checkin_month" if self.by_month else None)

    def reviews_in(self, days: DayRange) -> DataFrame:
        return in_days(self.reviews, "review_date", days, "review_month" if self.by_month else None)

    def payment_totals(
        self,
        payments: DataFrame,
        *,
        listing: Sequence[str],
        by: Sequence[str] = (),
        via_booking: bool = False,
    ) -> DataFrame:
        """``cents`` and ``n`` of payments per ``by`` columns and ``listing`` columns.

        ``listing`` may hold ``listing_id`` and attributes of the listing. With
        ``via_booking`` the listing is the booking's even if the payment names one.

        The join to bookings stands directly on its two shuffles: there Spark sees the
        real sizes, splits a booking with a huge share of the payments, and hashes or
        broadcasts the smaller side if it fits. Sums per booking would save nothing,
        a booking has few payments, and would take that choice away. Listings have many:
        payments are added up per listing first, so that one with a huge share brings one
        row per map task, and Spark chooses the join to listings by the sizes it then sees.
        Totals are added up again after it, in place if they stay per listing: a listing
        that stands in the dimension k times counts k times, in one row.
        """
        attributes = [c for c in listing if c != "listing_id"]
        n = F.count(F.lit(1)).alias("n")
        if via_booking or "listing_id" not in payments.columns:
            owner = self.bookings.select("booking_id", "listing_id")
            payments = payments.select("booking_id", "amount", *by).join(owner, "booking_id")
        if not attributes:
            return payments.groupBy(*by, *listing).agg(total_cents().alias("cents"), n)
        dimension = self.listings.select("listing_id", *attributes)
        whole, parts = split(F.col("amount"))
        per_listing = payments.groupBy("listing_id", *by).agg(
            F.sum(whole).alias("whole"), F.sum(parts).alias("parts"), n
        )
        return (
            per_listing.join(dimension, "listing_id")
            .groupBy(*by, *listing)
            .agg(joined(F.sum("whole"), F.sum("parts")).alias("cents"), F.sum("n").alias("n"))
        )
