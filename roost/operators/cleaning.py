"""Raw records to typed, valid rows, one per natural key.

A domain is described by data: the type of each output column, the rules a row must
pass, the partition column derived from it, and how duplicates are settled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roost.functions import casts
from roost.functions.calendar import month_key
from roost.operators.dedupe import first_per_key

Cast = Callable[[str], Column]


@dataclass(frozen=True)
class Domain:
    """Cleaning of one dataset.

    ``columns`` maps each output column to its raw column, or to (raw column, cast).
    ``rules`` are SQL predicates over the typed row; NULL does not pass.
    """

    columns: dict[str, str | tuple[str, Cast]]
    rules: tuple[str, ...]
    key: str
    order: str
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)

    def typed(self, raw: DataFrame) -> DataFrame:
        picked = []
        for name, origin in self.columns.items():
            column = F.col(origin) if isinstance(origin, str) else origin[1](origin[0])
            picked.append(column.alias(name))
        return raw.select(*picked)

    def valid(self, raw: DataFrame) -> DataFrame:
        return self.typed(raw).where(" AND ".join(f"({rule})" for rule in self.rules))

    def clean(self, raw: DataFrame) -> DataFrame:
        """Typed, valid and unique rows. The partition column is derived last, so the
        shuffle that finds duplicates does not carry it."""
        unique = first_per_key(self.valid(raw), self.key, self.order)
        return unique.withColumns({name: make() for name, make in self.derived.items()})


def _present(*columns: str) -> tuple[str, ...]:
    return tuple(f"{c} IS NOT NULL" for c in columns)


def _filled(*columns: str) -> tuple[str, ...]:
    return tuple(f"trim({c}) <> ''" for c in columns)


LISTINGS = Domain(
    columns={
        "id": "id",
        "name": "name",
        "host_id": "host_id",
        "neighbourhood": "neighbourhood",
        "room_type": "room_type",
        "price": ("price", casts.number),
        "minimum_nights": ("minimum_nights", casts.whole),
    },
    rules=(*_present("id", "minimum_nights"), *_filled("name"), "price > 0"),
    key="id",
    order="host_id",
)

REVIEWS = Domain(
    columns={
        "id": "id",
        "listing_id": "listing_id",
        "reviewer_id": "reviewer_id",
        "reviewer_name": "reviewer_name",
        "rating": ("rating", casts.whole),
        "comments": "comments",
        "review_date": ("date", casts.day),
    },
    rules=(
        *_present("id", "listing_id", "reviewer_id", "review_date"),
        *_filled("comments"),
        "rating BETWEEN 1 AND 5",
    ),
    derived={"review_month": lambda: month_key(F.col("review_date"))},
    key="id",
    order="review_date",
)

BOOKINGS = Domain(
    columns={
        "booking_id": "booking_id",
        "listing_id": "listing_id",
        "guest_id": "guest_id",
        "checkin_date": ("checkin_date", casts.day),
        "checkout_date": ("checkout_date", casts.day),
        "nights": ("nights", casts.whole),
        "amount": ("amount", casts.number),
        "status": "status",
    },
    rules=(
        *_present("booking_id", "listing_id", "guest_id", "status"),
        "checkout_date > checkin_date",
        "nights > 0",
        "amount > 0",
    ),
    derived={"checkin_month": lambda: month_key(F.col("checkin_date"))},
    key="booking_id",
    order="checkin_date",
)

TRANSACTIONS = Domain(
    columns={
        "txn_id": "txn_id",
        "booking_id": "booking_id",
        "ts": ("ts", casts.moment),
        "amount": ("amount", casts.number),
        "currency": "currency",
        "payment_method": "payment_method",
        "status": "status",
    },
    rules=(
        *_present("txn_id", "booking_id", "ts", "status"),
        "amount > 0",
        *_filled("currency", "payment_method"),
    ),
    derived={"txn_date": lambda: F.to_date("ts")},
    key="txn_id",
    order="ts",
)

DOMAINS = {
    "listings": LISTINGS,
    "reviews": REVIEWS,
    "bookings": BOOKINGS,
    "transactions": TRANSACTIONS,
}

clean_listings = LISTINGS.clean
clean_reviews = REVIEWS.clean
clean_bookings = BOOKINGS.clean
clean_transactions = TRANSACTIONS.clean
