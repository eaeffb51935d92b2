"""The gate between clean tables and marts: one aggregate, then a verdict."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


class DataQualityError(RuntimeError):
    """A table failed its gate."""


@dataclass(frozen=True)
class Gate:
    """What must hold of a table.

    ``keys``: the unique key first, then the other columns that may not be NULL.
    ``forbidden``: name to SQL predicate; no row may satisfy it.
    ``watched``: name to SQL predicate; counted, but no reason to stop.
    ``dense``: whole-number keys are counted in bitmaps of 32,768 neighbouring numbers. For
    numbered keys, whose neighbours mostly lie in one file, each map task then sends a few
    bits a key. Scattered keys, such as hashes, are counted right but cost more that way.
    """

    table: str
    keys: Sequence[str]
    forbidden: dict[str, str] = field(default_factory=dict)
    watched: dict[str, str] = field(default_factory=dict)
    dense: bool = False

    def measure(self, df: DataFrame) -> DataFrame:
        """One row of counts, from one pass over the table."""
        key = F.col(self.keys[0])
        null_key = " OR ".join(f"{c} IS NULL" for c in self.keys)
        counted = {"null_keys": null_key, **self.forbidden, **self.watched}
        counts = [
            F.count(F.lit(1)).alias("row_count"),
            F.count(key).alias("_with_id"),
            *[F.count_if(F.expr(rule)).alias(name) for name, rule in counted.items()],
        ]
        if self.dense and isinstance(df.schema[self.keys[0]].dataType, IntegralType):
            # Without a key there is no bit; position 0 stands in, and is not counted.
            bits = F.bitmap_construct_agg(F.coalesce(F.bitmap_bit_position(key), F.lit(0)))
            parts = df.groupBy(F.bitmap_bucket_number(key).alias("_bucket")).agg(
                *counts, bits.alias("_bits")
            )
            distinct = F.when(F.col("_bucket").isNotNull(), F.bitmap_count("_bits")).alias("distinct_ids")
            parts = parts.select("row_count", "_with_id", distinct, *counted)
            total = parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts.columns])
        else:
            total = df.agg(*counts, F.count_distinct(key).alias("distinct_ids"))
        return total.select(
            "row_count",
            "distinct_ids",
            (F.col("_with_id") - F.col("distinct_ids")).alias("duplicate_ids"),
            *counted,
        )

    def check(self, df: DataFrame) -> QualityReport:
        """Measure the table; raise on the first rule it breaks."""
        counts = self.measure(df).first().asDict()
        report = QualityReport(self.table, counts)
        if report.row_count == 0:
            raise DataQualityError(f"{self.table}: the table is empty")
        for name in ("duplicate_ids", "null_keys", *self.forbidden):
            if counts[name]:
                raise DataQualityError(f"{self.table}: {counts[name]} rows counted as {name}")
        return report


@dataclass(frozen=True)
class QualityReport:
    table: str
    counts: dict[str, int]

    @property
    def row_count(self) -> int:
        return self.counts["row_count"]

    @property
    def distinct_ids(self) -> int:
        return self.counts["distinct_ids"]

    @property
    def duplicate_ids(self) -> int:
        return self.counts["duplicate_ids"]


GATES = {
    "listings": Gate("listings", ("id",), {"bad_prices": "price <= 0"}),
    "reviews": Gate(
        "reviews",
        ("id", "listing_id"),
        {"out_of_range_ratings": "rating < 1 OR rating > 5"},
        {"null_ratings": "rating IS NULL"},
        dense=True,
    ),
    "bookings": Gate(
        "bookings",
        ("booking_id", "listing_id", "guest_id"),
        {"bad_stays": "checkout_date <= checkin_date OR nights <= 0", "bad_amounts": "amount <= 0"},
        dense=True,
    ),
    "transactions": Gate(
        "transactions", ("txn_id", "booking_id"), {"bad_amounts": "amount <= 0"}, dense=True
    ),
}


def check_reviews(reviews: DataFrame) -> QualityReport:
    return GATES["reviews"].check(reviews)
