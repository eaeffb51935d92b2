"""Generators: repeatable, linked, within their window, with the promised defects."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from roost.operators.cleaning import DOMAINS
from roost.schemas import RAW
from roost.sources import synthetic
from roost.sources.synthetic import FACT_SHARE, Scale, measured_row_bytes, scale_for
from roost.sources.synthetic_raw import FIRST_ID, RawData


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_same_data_on_any_number_of_partitions(spark):
    def facts(partitions):
        return rows(synthetic.transactions(spark.range(0, 500, 1, partitions), 40, 90))

    assert facts(1) == facts(7)


@pytest.mark.parametrize("dataset, key, day", [
    ("transactions", "txn_id", "txn_date"),
    ("bookings", "booking_id", "checkin_date"),
    ("reviews", "review_id", "review_date"),
])
def test_days_follow_the_id_and_never_overflow(spark, dataset, key, day):
    ids = [0, 1, 729, 730, 10**6 + 7, 3_470_000_001, 4_760_000_000, 9 * 10**15]
    build = getattr(synthetic, dataset)
    source = spark.createDataFrame([(i,) for i in ids], "id BIGINT")
    made = build(source, 50, 60) if dataset == "transactions" else build(source, 50)
    found = {r[key]: r[day] for r in made.select(key, day).collect()}
    step = synthetic.DAY_STEP[dataset]
    assert {k: (v - date(2023, 1, 1)).days for k, v in found.items()} == {i: i * step % 730 for i in ids}


def test_wide_tables_have_their_columns_and_ranges(spark):
    tables = Scale(2_000, 400, 600, 50).tables(spark)
    paid = tables["transactions"]
    assert paid.columns == [
        "txn_id", "booking_id", "listing_id", "txn_date", "ts", "txn_month", "amount", "status",
        "currency", "payment_method", "ballast",
    ]
    low, high = paid.agg(F.min("amount"), F.max("amount")).first()
    assert 50 <= low < 60 and 990 < high <= 1000
    # every payment's booking and listing exists
    assert paid.join(tables["bookings"], "booking_id", "left_anti").count() == 0
    assert paid.join(tables["listings"], "listing_id", "left_anti").count() == 0
    assert {r.status for r in paid.select("status").distinct().collect()} == set(
        synthetic.PAYMENT_STATUSES
    )
    assert tables["bookings"].where("checkout_date <> date_add(checkin_date, nights)").count() == 0


def test_target_size_gives_row_counts(spark):
    sizes = measured_row_bytes(spark, sample_rows=20_000)
    assert set(sizes) == set(FACT_SHARE) and all(1 < v < 200 for v in sizes.values())
    scale = scale_for(1e9, {"transactions": 40, "bookings": 40, "reviews": 20}, listings=7)
    assert scale == Scale(20_000_000, 3_000_000, 4_000_000, 7)


def test_generate_facts_job(spark, tmp_path):
    from roost.jobs import generate_facts

    written = generate_facts.run(spark, str(tmp_path), 0.0005, "reviews", sample_rows=10_000)
    assert set(written) == {"reviews"}
    assert spark.read.parquet(f"{tmp_path}/reviews").count() == written["reviews"]


@pytest.fixture(scope="module")
def data():
    return RawData(listings=300, seed=5)


@pytest.fixture(scope="module")
def raw(spark, data):
    return {name: df.cache() for name, df in data.tables(spark).items()}


def test_same_seed_same_records(spark, data, raw):
    again = RawData(listings=300, seed=5).tables(spark)
    other = RawData(listings=300, seed=6).tables(spark)
    for name in raw:
        assert rows(again[name].repartition(3)) == rows(raw[name])
        assert rows(other[name]) != rows(raw[name])


def test_raw_columns(raw):
    for name, df in raw.items():
        assert df.columns == [c.split()[0] for c in RAW[name].split(", ")]


def test_listings_are_clean_and_single(raw):
    assert raw["listings"].count() == raw["listings"].select("id").distinct().count() == 300
    assert raw["listings"].agg(F.min("id")).first()[0] == FIRST_ID["listings"]
    assert DOMAINS["listings"].clean(as_text(raw, "listings")).count() == 300


def as_text(raw, name):
    """The records as a cleaner reads them back."""
    columns = [c.split() for c in RAW[name].split(", ")]
    return raw[name].select(*[F.col(c).cast(t).alias(c) for c, t in columns])


def test_one_to_twice_the_average_children(raw):
    # listing references of dirty reviews may be missing, so count by id instead
    per_listing = (
        raw["reviews"].select("id").distinct()
        .groupBy(F.expr(f"(id - {FIRST_ID['reviews']}) DIV 12")).count()
    )
    sizes = [r["count"] for r in per_listing.collect()]
    assert len(sizes) == 300 and min(sizes) == 1 and max(sizes) == 12


@pytest.mark.parametrize("name, key", [("reviews", "id"), ("bookings", "booking_id"), ("transactions", "txn_id")])
def test_defects_and_repeats_come_as_often_as_asked(raw, name, key):
    records = raw[name].count()
    ids = raw[name].select(key).distinct().count()
    valid_ids = DOMAINS[name].clean(as_text(raw, name)).count()
    dirty = 1 - valid_ids / ids
    # payments of a dirty booking may be invalid too, through its amount
    assert 0.04 < dirty < (0.13 if name == "transactions" else 0.12)
    assert 0.02 < records / ids - 1 < 0.08
    # only clean records repeat; a payment may still carry a dirty booking's amount
    twice = as_text(raw, name).groupBy(*raw[name].columns).count().where("count > 1").drop("count")
    if name == "transactions":
        twice = twice.where("amount <> '-1.0'")
    assert DOMAINS[name].valid(twice).count() == twice.count()


def test_five_defects_each(raw):
    assert raw["reviews"].where("listing_id IS NULL").count() > 0
    assert raw["reviews"].where("comments = '   '").count() > 0
    assert raw["reviews"].where("date = 'not-a-date'").count() > 0
    assert raw["reviews"].where("reviewer_id IS NULL").count() > 0
    assert raw["reviews"].where("rating = 0").count() > 0
    assert raw["bookings"].where("listing_id IS NULL").count() > 0
    assert raw["bookings"].where("checkin_date = 'not-a-date'").count() > 0
    assert raw["bookings"].where("guest_id IS NULL").count() > 0
    assert raw["bookings"].where("nights = 0").count() > 0
    assert raw["bookings"].where("amount = -1.0").count() > 0
    assert raw["transactions"].where("booking_id IS NULL").count() > 0
    assert raw["transactions"].where("ts = 'not-a-timestamp'").count() > 0
    assert raw["transactions"].where("amount IS NULL").count() > 0
    assert raw["transactions"].where("currency = '  '").count() > 0
    assert raw["transactions"].where("payment_method = ''").count() > 0


def test_references_resolve(raw):
    listings, bookings = raw["listings"], raw["bookings"]
    for child in ("reviews", "bookings"):
        linked = raw[child].where("listing_id IS NOT NULL")
        assert linked.join(listings, linked.listing_id == listings.id, "left_anti").count() == 0
    paid = raw["transactions"].where("booking_id IS NOT NULL")
    settled = bookings.where("status IN ('completed', 'confirmed')").dropDuplicates(["booking_id"])
    assert paid.join(settled, "booking_id", "left_anti").count() == 0
    amounts = paid.where("amount IS NOT NULL").join(
        settled.withColumnRenamed("amount", "booked"), "booking_id"
    )
    assert amounts.where("amount <> booked").count() == 0


def test_payments_per_booking(raw):
    per_booking = (
        raw["transactions"].select("txn_id").distinct()
        .groupBy(F.expr(f"(txn_id - {FIRST_ID['transactions']}) DIV 2")).count()
    )
    sizes = [r["count"] for r in per_booking.collect()]
    assert set(sizes) == {1, 2} and 0.15 < sizes.count(2) / len(sizes) < 0.35


def test_no_dirt_on_request(spark):
    clean = RawData(listings=100, dirty_ratio=0, duplicate_ratio=0).tables(spark)
    for name, key in (("reviews", "id"), ("bookings", "booking_id"), ("transactions", "txn_id")):
        records = as_text(clean, name)
        assert DOMAINS[name].valid(records).count() == records.select(key).distinct().count()
