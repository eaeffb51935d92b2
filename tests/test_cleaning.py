"""Cleaners on literal rows: defects, repeats, odd numbers, broken lines."""

import pytest

from roost.operators.cleaning import (
    DOMAINS,
    clean_bookings,
    clean_listings,
    clean_reviews,
    clean_transactions,
)
from roost.operators.dedupe import first_per_key
from roost.paths import LakePaths
from roost.schemas import CLEAN, CLEAN_PARTITION, RAW
from roost.sources.raw import read_raw

GOOD = {
    "listings": dict(id=1, name="Loft", host_id=7, neighbourhood="A", room_type="R", price="80.5",
                     minimum_nights="2"),
    "reviews": dict(id=1, listing_id=10, date="2024-03-05", reviewer_id=5, reviewer_name="Ana",
                    rating="4", comments="fine"),
    "bookings": dict(booking_id=7001, listing_id=10, guest_id=3, checkin_date="2024-05-01",
                     checkout_date="2024-05-04", nights="3", amount="300.0", status="completed"),
    "transactions": dict(txn_id=9001, booking_id=7001, ts="2024-05-01T10:11:12", amount="300.0",
                         currency="USD", payment_method="card", status="succeeded"),
}
KEY = {"listings": "id", "reviews": "id", "bookings": "booking_id", "transactions": "txn_id"}


def raw(spark, dataset, *changes):
    rows = [{**GOOD[dataset], **change} for change in changes]
    names = [c.split()[0] for c in RAW[dataset].split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], RAW[dataset])


def kept(df, dataset):
    return sorted(row[KEY[dataset]] for row in DOMAINS[dataset].clean(df).collect())


def defects(dataset, **values):
    """The good row, then one row per defect with the following key."""
    first = GOOD[dataset][KEY[dataset]]
    return [{}] + [
        {**defect, KEY[dataset]: first + number}
        for number, defect in enumerate(
            ({column: bad} for column, bads in values.items() for bad in bads), start=1
        )
    ]


def test_reviews_with_a_defect_go(spark):
    bad = defects(
        "reviews",
        listing_id=[None],
        date=["not-a-date", None, "2024-13-01"],
        comments=["   ", "", None],
        reviewer_id=[None],
        rating=["0", "6", "five", None],
    )
    assert kept(raw(spark, "reviews", *bad, {"id": None}), "reviews") == [1]


def test_bookings_with_a_defect_go(spark):
    bad = defects(
        "bookings",
        listing_id=[None],
        guest_id=[None],
        checkin_date=["not-a-date", "2024-05-04", "2024-06-01"],
        checkout_date=[None],
        nights=["0", "-1", "x"],
        amount=["-1.0", "0", "NaN", "Infinity", None],
        status=[None],
    )
    assert kept(raw(spark, "bookings", *bad, {"booking_id": None}), "bookings") == [7001]


def test_transactions_with_a_defect_go(spark):
    bad = defects(
        "transactions",
        booking_id=[None],
        ts=["not-a-timestamp", None],
        amount=[None, "0", "NaN"],
        currency=["  ", None],
        payment_method=["", None],
        status=[None],
    )
    assert kept(raw(spark, "transactions", *bad, {"txn_id": None}), "transactions") == [9001]


def test_listings_with_a_defect_go(spark):
    bad = defects(
        "listings",
        name=["  ", None],
        price=["n/a", "0", "-3", "NaN", "Infinity", None],
        minimum_nights=["x", None],
    )
    assert kept(raw(spark, "listings", *bad, {"id": None}), "listings") == [1]


def test_unchecked_columns_may_be_null(spark):
    loose = {"host_id": None, "neighbourhood": None, "room_type": None}
    assert kept(raw(spark, "listings", loose), "listings") == [1]
    assert kept(raw(spark, "reviews", {"reviewer_name": None}), "reviews") == [1]


@pytest.mark.parametrize("dataset", list(GOOD))
def test_repeated_rows_collapse(spark, dataset):
    assert DOMAINS[dataset].clean(raw(spark, dataset, {}, {}, {})).count() == 1


@pytest.mark.parametrize("dataset", list(GOOD))
def test_clean_schema_is_the_declared_one(spark, dataset):
    declared = CLEAN[dataset] + (f", {CLEAN_PARTITION[dataset]}" if CLEAN_PARTITION[dataset] else "")
    expected = spark.createDataFrame([], declared).dtypes
    assert DOMAINS[dataset].clean(raw(spark, dataset, {})).dtypes == expected


def test_the_earliest_wins(spark):
    rows = raw(
        spark, "transactions", {"ts": "2024-05-03"}, {"ts": "2024-05-01", "amount": "1"}, {"ts": "2024-05-02"}
    )
    assert clean_transactions(rows).first().amount == 1.0
    hosts = raw(spark, "listings", {"host_id": 9}, {"host_id": 3, "name": "first"}, {"host_id": 5})
    assert clean_listings(hosts).first()["name"] == "first"


def test_ties_do_not_depend_on_order(spark):
    changes = [{"comments": c} for c in ("b", "a", "c")]
    for order in (changes, changes[::-1]):
        assert clean_reviews(raw(spark, "reviews", *order)).first().comments == "a"


def test_partition_columns(spark):
    assert clean_reviews(raw(spark, "reviews", {})).first().review_month == "2024-03"
    assert clean_bookings(raw(spark, "bookings", {})).first().checkin_month == "2024-05"
    assert str(clean_transactions(raw(spark, "transactions", {})).first().txn_date) == "2024-05-01"


@pytest.mark.parametrize(
    "text, value", [("4", 4), ("4.0", 4), ("4.7", 4), (" 3 ", 3), ("+2", 2), ("1.", 1)]
)
def test_whole_numbers_lose_their_fraction(spark, text, value):
    assert clean_reviews(raw(spark, "reviews", {"rating": text})).first().rating == value


@pytest.mark.parametrize("text", ["", "x", "4.x", "NaN", "99999999999", "1e0", "--1"])
def test_other_text_is_no_number(spark, text):
    assert clean_reviews(raw(spark, "reviews", {"rating": text})).count() == 0


def test_broken_lines_are_dropped(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    folder = tmp_path / "bronze" / "reviews" / "ingest_date=2024-11-30"
    folder.mkdir(parents=True)
    good = (
        '{"id": 1, "listing_id": 10, "date": "2024-03-05", "reviewer_id": 5, "rating": 4, "comments": "ok"}'
    )
    (folder / "part.json").write_text(f'{good}\n{{bad\n{{"id": "x", "listing_id": 10}}\n\n')
    assert kept(read_raw(spark, paths, "reviews"), "reviews") == [1]


def test_one_key_under_two_ingest_dates(spark, tmp_path):
    from roost.sinks.tables import land

    paths = LakePaths.under(str(tmp_path))
    land(raw(spark, "reviews", {"date": "2024-03-09"}), paths, "reviews", "2024-11-30")
    land(raw(spark, "reviews", {"date": "2024-03-08"}), paths, "reviews", "2024-12-01")
    both = read_raw(spark, paths, "reviews")
    assert "ingest_date" not in both.columns
    assert [str(r.review_date) for r in clean_reviews(both).collect()] == ["2024-03-08"]
    assert read_raw(spark, paths, "reviews", "2024-11-30").count() == 1


def test_first_per_key_keeps_all_columns(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "z"), (2, 5, None)], "k INT, o INT, v STRING")
    assert sorted(tuple(r) for r in first_per_key(rows, "k", "o").collect()) == [(1, 1, "z"), (2, 5, None)]
