"""Raw records with known defects and repeats, for exercising the cleaners.

Four linked domains come from a range of listings. Children are exploded from their
parent with an id computed from the parent's place and their own number, so every id
is unique, every reference resolves, and nothing passes through the driver. All picks
hash the record's id with the seed: same seed, same data, on any cluster.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roost.functions.picks import below, between, chance, choice, weighted
from roost.sources.synthetic import NEIGHBOURHOODS, ROOM_TYPES

# First ids, weights and date spans.
FIRST_ID = {"listings": 1_000, "reviews": 5_000_001, "bookings": 7_000_001, "transactions": 9_000_001}
MINIMUM_NIGHTS = {1: 2, 2: 2, 3: 1, 5: 1, 7: 1}
STAY_NIGHTS = {1: 1, 2: 2, 3: 2, 4: 1, 5: 1, 7: 1, 10: 1, 14: 1}
BOOKING_STATUS = {"completed": 4, "confirmed": 2, "cancelled": 1, "no_show": 1}
PAYMENT_STATUS = {"succeeded": 5, "failed": 1, "refunded": 1}
PAYMENT_METHOD = {"card": 3, "paypal": 1, "apple_pay": 1, "google_pay": 1, "bank_transfer": 1}
CURRENCY = {"USD": 3, "EUR": 1, "GBP": 1, "AUD": 1}
PAYMENTS_PER_BOOKING = {1: 3, 2: 1}
REVIEW_DAYS = (date(2024, 1, 1), date(2024, 11, 30))
CHECKIN_DAYS = (date(2024, 1, 1), date(2024, 12, 15))
PAYMENT_DAYS = (date(2024, 1, 1), date(2024, 12, 20))


@dataclass(frozen=True)
class RawData:
    """Size and dirt of a raw data set."""

    listings: int = 400
    reviews_per_listing: int = 6
    bookings_per_listing: int = 4
    dirty_ratio: float = 0.08
    duplicate_ratio: float = 0.05
    seed: int = 42

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        listings = self._listings(spark)
        bookings = self._bookings(listings)
        return {
            "listings": listings,
            "reviews": self._repeated(self._reviews(listings), "id"),
            "bookings": self._repeated(bookings, "booking_id"),
            "transactions": self._repeated(self._transactions(bookings), "txn_id"),
        }

    def _day(self, key: Column, span: tuple[date, date], salt: str) -> Column:
        first, last = span
        offset = below(key, (last - first).days + 1, salt, self.seed)
        return F.date_add(F.lit(first), offset.cast("int"))

    def _dollars(self, key: Column, salt: str) -> Column:
        return between(key, 4_500, 65_000, salt, self.seed) / 100

    def _children(self, listings: DataFrame, average: int, dataset: str, key: str) -> DataFrame:
        """One to twice the average children per listing, each with its id."""
        most = 2 * average
        number = between(F.col("id"), 1, most, f"{dataset} of listing", self.seed)
        place = F.col("id") - FIRST_ID["listings"]
        return listings.select(
            F.col("id").alias("listing_id"),
            F.explode(F.sequence(F.lit(0), (number - 1).cast("int"))).alias("_child"),
            place.alias("_place"),
        ).select((F.col("_place") * most + F.col("_child") + FIRST_ID[dataset]).alias(key), "listing_id")

    def _spoil(self, rows: DataFrame, key: str, defects: dict[str, Column]) -> DataFrame:
        """Give each dirty row one of the defects, each as likely as the others."""
        dirty = rows.withColumns(
            {
                "_dirty": chance(F.col(key), self.dirty_ratio, f"{key} dirty", self.seed),
                "_defect": below(F.col(key), len(defects), f"{key} defect", self.seed),
            }
        )
        spoiled = {
            name: F.when(F.col("_dirty") & (F.col("_defect") == number), bad).otherwise(F.col(name))
            for number, (name, bad) in enumerate(defects.items())
        }
        return dirty.withColumns(spoiled).drop("_defect")

    def _repeated(self, rows: DataFrame, key: str) -> DataFrame:
        """Emit some clean rows twice."""
        again = ~F.col("_dirty") & chance(F.col(key), self.duplicate_ratio, f"{key} again", self.seed)
        copies = F.sequence(F.lit(1), F.when(again, 2).otherwise(1))
        return rows.select("*", F.explode(copies).alias("_copy")).drop("_copy", "_dirty")

    def _listings(self, spark: SparkSession) -> DataFrame:
        key, seed = F.col("id"), self.seed
        first = FIRST_ID["listings"]
        return spark.range(first, first + self.listings).select(
            "id",
            F.concat_ws(
                " ",
                F.lit("Place"),
                key,
                choice(key, NEIGHBOURHOODS, "named area", seed),
            ).alias("name"),
            between(key, 100_000, 999_999, "host", seed).alias("host_id"),
            choice(key, NEIGHBOURHOODS, "area", seed).alias("neighbourhood"),
            choice(key, ROOM_TYPES, "room", seed).alias("room_type"),
            self._dollars(key, "price").alias("price"),
            weighted(key, MINIMUM_NIGHTS, "minimum nights", seed).alias("minimum_nights"),
        )

    def _reviews(self, listings: DataFrame) -> DataFrame:
        key, seed = F.col("id"), self.seed
        rows = self._children(listings, self.reviews_per_listing, "reviews", "id").select(
            "id",
            "listing_id",
            self._day(key, REVIEW_DAYS, "review day").cast("string").alias("date"),
            between(key, 1_000_000, 9_999_999, "reviewer", seed).alias("reviewer_id"),
            F.concat(F.lit("reviewer "), below(key, 10_000, "reviewer name", seed)).alias("reviewer_name"),
            between(key, 1, 5, "rating", seed).alias("rating"),
            F.concat(F.lit("remark "), below(key, 1_000, "remark", seed)).alias("comments"),
        )
        defects = {
            "listing_id": F.lit(None),
            "comments": F.lit("   "),
            "date": F.lit("not-a-date"),
            "reviewer_id": F.lit(None),
            "rating": F.lit(0),
        }
        return self._spoil(rows, "id", defects)

    def _bookings(self, listings: DataFrame) -> DataFrame:
        key, seed = F.col("booking_id"), self.seed
        children = self._children(listings, self.bookings_per_listing, "bookings", "booking_id")
        checkin = self._day(key, CHECKIN_DAYS, "checkin")
        nights = weighted(key, STAY_NIGHTS, "nights", seed)
        rows = children.select(
            "booking_id",
            "listing_id",
            between(key, 2_000_000, 8_999_999, "guest", seed).alias("guest_id"),
            checkin.cast("string").alias("checkin_date"),
            F.date_add(checkin, nights).cast("string").alias("checkout_date"),
            nights.alias("nights"),
            F.round(self._dollars(key, "nightly rate") * nights, 2).alias("amount"),
            weighted(key, BOOKING_STATUS, "booking status", seed).alias("status"),
        )
        defects = {
            "listing_id": F.lit(None),
            "checkin_date": F.lit("not-a-date"),
            "guest_id": F.lit(None),
            "nights": F.lit(0),
            "amount": F.lit(-1.0),
        }
        return self._spoil(rows, "booking_id", defects)

    def _transactions(self, bookings: DataFrame) -> DataFrame:
        """One or two payments, of the booking's amount, for bookings not called off."""
        seed, booking = self.seed, F.col("booking_id")
        most = max(PAYMENTS_PER_BOOKING)
        number = weighted(booking, PAYMENTS_PER_BOOKING, "payments", seed)
        place = booking - FIRST_ID["bookings"]
        key = F.col("txn_id")
        second = below(key, 86_400, "second of day", seed)
        paid = (
            bookings.where(F.col("status").isin("completed", "confirmed"))
            .select("booking_id", "amount", F.explode(F.sequence(F.lit(1), number)).alias("_nth"))
            .withColumn("txn_id", place * most + F.col("_nth") - 1 + FIRST_ID["transactions"])
        )
        rows = paid.select(
            "txn_id",
            "booking_id",
            F.date_format(
                F.timestamp_seconds(
                    F.unix_date(self._day(key, PAYMENT_DAYS, "payment day")) * F.lit(86_400) + second
                ),
                "yyyy-MM-dd'T'HH:mm:ss",
            ).alias("ts"),
            "amount",
            weighted(key, CURRENCY, "currency", seed).alias("currency"),
            weighted(key, PAYMENT_METHOD, "method", seed).alias("payment_method"),
            weighted(key, PAYMENT_STATUS, "payment status", seed).alias("status"),
        )
        defects = {
            "booking_id": F.lit(None),
            "ts": F.lit("not-a-timestamp"),
            "amount": F.lit(None),
            "currency": F.lit("  "),
            "payment_method": F.lit(""),
        }
        return self._spoil(rows, "txn_id", defects)
