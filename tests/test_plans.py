"""What the plans do: skip directories, share scans, split and shrink hot keys."""

from dataclasses import replace
from datetime import timedelta

import pytest

from roost.operators.pruning import in_days
from roost.plans import marts, star
from roost.plans.registry import REGISTRY
from roost.plans.workloads import WORKLOADS
from roost.sinks.layout import TUNED, write_tuned
from roost.sources import mapped
from roost.sources.stored import load_layout
from roost.sources.synthetic import START, Scale
from tests.conftest import SMALL, plan_of
from tests.marketplaces import small_marketplace


@pytest.fixture(scope="module")
def tuned(spark, tmp_path_factory):
    from roost.plans.layouts import write_tuned_layout

    base = str(tmp_path_factory.mktemp("tuned"))
    scale = Scale(20_000, 6_000, 6_000, 500)
    write_tuned_layout(spark, base, scale.tables(spark))
    return load_layout(spark, base, START, by_month=True)


RANGED = ["q01", "q03", "q04", "q05", "q06", "q07", "q08", "q13", "q16", "q17", "q18", "q20", "q22"]


@pytest.mark.parametrize("key", [k for k in WORKLOADS if k[:3] in RANGED])
def test_day_filters_skip_month_directories(tuned, key):
    assert "_month" in plan_of(WORKLOADS[key].plan(tuned)).split("PartitionFilters: [", 1)[1].split("]")[0]


def test_only_wanted_months_are_read(spark, tuned):
    days = tuned.span(400, 30)
    files = in_days(tuned.payments, "txn_date", days, "txn_month").select("_metadata.file_path").distinct()
    months = {row[0].split("txn_month=")[1][:7] for row in files.collect()}
    assert months == {"2024-02", "2024-03"}


def test_pruned_rows_equal_unpruned_rows(tuned):
    days = tuned.span(15, 20)
    pruned = in_days(tuned.payments, "txn_date", days, "txn_month")
    assert pruned.count() == tuned.payments.where(days.holds("txn_date")).count() > 0


def test_scans_read_only_used_columns(spark):
    plan = plan_of(REGISTRY["q19_wide_scan"](spark, SMALL))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in plan


def test_date_ranges_reach_the_scan(spark):
    plan = plan_of(REGISTRY["q01_date_range_revenue"](spark, SMALL))
    assert "GreaterThanOrEqual(l_shipdate,1998-02-05T00:00)" in plan


@pytest.mark.parametrize("key", ["q01_date_range_revenue", "q05_txn_booking_join", "q09_running_total"])
def test_listing_is_not_looked_up_where_unused(spark, key):
    assert "customer.parquet" not in plan_of(REGISTRY[key](spark, SMALL))


def test_facts_shrink_before_they_meet_listings(spark, setting):
    setting(**{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    lake = mapped.marketplace(spark, SMALL)
    plan = plan_of(WORKLOADS["q07_review_listing_join"].plan(lake))
    assert "BroadcastHashJoin" not in plan
    assert plan.index("SortMergeJoin") < plan.index("keys=[listing_id")


def test_planning_a_join_with_listings_runs_no_job(spark):
    lake = mapped.marketplace(spark, SMALL)
    spark.sparkContext.setJobGroup("planning", "q04")
    try:
        WORKLOADS["q04_txn_listing_join"].plan(lake)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_share_computes_revenue_once(spark):
    df = REGISTRY["q12_nbhd_share"](spark, SMALL)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_share_needs_no_window(spark):
    assert "Window" not in plan_of(REGISTRY["q12_nbhd_share"](spark, SMALL))


@pytest.mark.parametrize("name", ["clean_reviews", "clean_transactions", "dedupe_earliest"])
def test_copies_are_dropped_before_the_shuffle(spark, name):
    plan = plan_of(REGISTRY[name](spark, SMALL))
    assert plan.index("Exchange") < plan.index("WindowGroupLimit", plan.index("Exchange"))


def test_marts_move_totals_not_names(spark):
    lake = mapped.marketplace(spark, SMALL)
    listings = mapped.listings(spark, SMALL)
    plan = plan_of(marts.reviews_per_listing(listings, lake.reviews))
    assert plan.index("Join") < plan.index("partial_count")


def test_booking_marts_shuffle_the_facts_once(spark, setting):
    setting(**{"spark.sql.autoBroadcastJoinThreshold": "10MB"})
    listings, bookings = mapped.listings(spark, SMALL), mapped.bookings(spark, SMALL)
    for mart in (marts.revenue_by_listing_month, marts.booking_conversion):
        assert plan_of(mart(listings, bookings)).count("Exchange hashpartitioning") == 1


def test_hot_booking_is_split(spark, setting, tmp_path):
    """A third of all payments belong to one booking; Spark splits it at run time."""
    rows = 90_000
    payments = spark.range(rows).selectExpr(
        "id AS txn_id", "IF(id % 3 = 0, 0, id % 20000) AS booking_id", "DATE '2023-09-20' AS txn_date",
        "'2023-09' AS txn_month", "CAST(id % 100 AS DOUBLE) AS amount", "'succeeded' AS status",
        "uuid() AS padding",
    )
    bookings = spark.range(20_000).selectExpr(
        "id AS booking_id", "id % 50 AS listing_id", "CAST(id % 5 AS INT) AS nights", "'completed' AS status"
    )
    payments.drop("padding").repartition(16).write.parquet(str(tmp_path / "payments"))
    lake = replace(
        small_marketplace(spark),
        payments=spark.read.parquet(str(tmp_path / "payments")),
        bookings=bookings,
    )
    setting(
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        }
    )
    df = WORKLOADS["q05_txn_booking_join"].plan(lake)
    found = {r.nights: (r.revenue, r.n) for r in df.collect()}
    assert "skew=true" in plan_of(df)
    expected = {}
    for i in range(rows):
        booking = 0 if i % 3 == 0 else i % 20000
        total, n = expected.get(booking % 5, (0.0, 0))
        expected[booking % 5] = (total + i % 100, n + 1)
    assert found == expected


def test_hot_listing_shrinks_before_the_shuffle(spark):
    """A third of the reviews are of one listing: it sends a row per map task."""
    reviews = spark.range(30_000).selectExpr(
        "id", "IF(id % 3 = 0, 1, id) AS listing_id", "CAST(id % 5 + 1 AS INT) AS rating"
    )
    listings = spark.range(30_000).selectExpr("id", "'n' AS name", "'a' AS neighbourhood")
    top = marts.reviews_per_listing(listings, reviews).first()
    assert (top.id, top.num_reviews) == (1, 10_001)


def test_summary_at_its_own_grain_is_not_added_up_again(tuned):
    assert "HashAggregate" not in plan_of(WORKLOADS["q10_topn_per_month"].plan(tuned))


def test_star_tables_have_their_columns(spark):
    lake = mapped.marketplace(spark, SMALL)
    assert tuple(star.fact_transactions(lake).columns) == TUNED["transactions"].columns
    assert tuple(star.fact_bookings(lake).columns) == TUNED["bookings"].columns
    assert tuple(star.fact_reviews(lake).columns) == TUNED["reviews"].columns
    assert tuple(star.dim_listing(lake).columns) == TUNED["listings"].columns
    assert tuple(star.summary_listing_month(lake).columns) == TUNED["summary"].columns


def test_span_of_months():
    from roost.functions.calendar import DayRange

    span = DayRange.after(START, 364, 1)
    assert span.month_keys() == ("2023-12", "2023-12")
    assert DayRange(START, START + timedelta(days=31)).month_keys() == ("2023-01", "2023-01")
    assert DayRange(START, START + timedelta(days=32)).month_keys() == ("2023-01", "2023-02")


def test_write_tuned_is_used_by_the_registry(spark, tmp_path):
    lake = mapped.marketplace(spark, SMALL)
    write_tuned(star.fact_reviews(lake), str(tmp_path / "r"), TUNED["reviews"])
    assert spark.read.parquet(str(tmp_path / "r")).count() == lake.reviews.count()
