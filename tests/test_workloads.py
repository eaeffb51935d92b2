"""Workload semantics on small fixtures, and the two paths to one answer."""

from dataclasses import replace
from datetime import timedelta

import pytest

from roost.plans import star
from roost.plans.workloads import WORKLOADS
from roost.sources import mapped
from tests.conftest import SMALL
from tests.marketplaces import START, small_marketplace

DUAL = [
    "q09_running_total",
    "q10_topn_per_month",
    "q11_moving_avg_3m",
    "q12_nbhd_share",
    "q14_mom_delta",
    "q15_pareto_share",
    "q21_gold_preagg",
]
# workloads that look up the listing of a payment or review
OF_LISTINGS = ["q04", "q06", "q07", "q10", "q12", "q13", "q15", "q18", "q20", "q21"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(offset):
    return START + timedelta(days=offset)


@pytest.fixture(scope="module")
def lake(spark):
    return mapped.marketplace(spark, SMALL)


@pytest.mark.parametrize("key", DUAL)
def test_summary_and_payments_agree(lake, key):
    with_summary = replace(lake, summary=star.summary_listing_month(lake))
    assert rows(WORKLOADS[key].plan(with_summary)) == rows(WORKLOADS[key].plan(lake))


@pytest.mark.parametrize("key", [k for k in WORKLOADS if k[:3] in OF_LISTINGS])
def test_stored_listing_ids_change_nothing(lake, key):
    """Through the booking or stored on the payment, a listing is the same."""
    stored = replace(lake, payments=star.fact_transactions(lake))
    assert rows(WORKLOADS[key].plan(stored)) == rows(WORKLOADS[key].plan(lake))


def test_conversion_without_payment_is_null_and_may_exceed_one(spark):
    lake = small_marketplace(
        spark,
        bookings=[(1, 10, day(351), 2, "completed"), (2, 11, day(352), 2, "completed")],
        payments=[
            (1, 1, 10, day(5), 10.0, "succeeded"),
            (2, 1, 10, day(700), 10.0, "succeeded"),
            (3, 2, 11, day(5), 10.0, "failed"),
        ],
    )
    assert rows(WORKLOADS["q17_conversion"].plan(lake)) == [(10, 1, 2, 2.0), (11, 1, None, None)]


def test_tied_third_place_keeps_all(spark):
    amounts = {1: 50.0, 2: 40.0, 3: 30.0, 4: 30.0, 5: 20.0, 6: 50.0}
    lake = small_marketplace(
        spark, payments=[(k, k, k, day(1), v, "succeeded") for k, v in amounts.items()]
    )
    found = {r.listing_id: r.rk for r in WORKLOADS["q10_topn_per_month"].plan(lake).collect()}
    assert found == {1: 1, 6: 1, 2: 2, 3: 3, 4: 3}


def test_moving_average_spans_rows_not_days(spark):
    days = [260, 261, 262, 263, 264, 265, 275, 276]
    lake = small_marketplace(
        spark, payments=[(i, i, 1, day(d), float(i), "succeeded") for i, d in enumerate(days)]
    )
    averages = {r.txn_date: r.moving_avg_7d for r in WORKLOADS["q22_moving_avg_7d"].plan(lake).collect()}
    assert averages[day(275)] == sum(range(7)) / 7
    assert averages[day(276)] == sum(range(1, 8)) / 7
    assert averages[day(261)] == 0.5


def test_ranges_are_half_open(spark):
    lake = small_marketplace(
        spark,
        payments=[(i, i, 1, day(d), 1.0, "failed") for i, d in enumerate([399, 400, 429, 430])],
    )
    assert rows(WORKLOADS["q01_date_range_revenue"].plan(lake)) == [("failed", 2.0, 2)]


def test_first_month_has_no_previous(spark):
    lake = small_marketplace(
        spark, payments=[(1, 1, 1, day(0), 5.0, "succeeded"), (2, 1, 1, day(40), 7.5, "succeeded")]
    )
    assert rows(WORKLOADS["q14_mom_delta"].plan(lake)) == [
        ("2023-01", 5.0, None, None),
        ("2023-02", 7.5, 5.0, 2.5),
    ]


def test_booking_names_the_listing_of_the_three_way_join(spark):
    lake = small_marketplace(
        spark,
        listings=[(1, "A", "whole"), (2, "B", "shared")],
        bookings=[(5, 2, day(1), 1, "completed")],
        payments=[(1, 5, 1, day(301), 9.0, "succeeded"), (2, 6, 1, day(301), 9.0, "succeeded")],
    )
    assert rows(WORKLOADS["q06_three_way_join"].plan(lake)) == [("shared", 9.0)]


def test_cents_add_up_exactly(spark):
    lake = small_marketplace(
        spark, payments=[(i, i, 1, day(1), 0.1, "succeeded") for i in range(1000)]
    )
    assert rows(WORKLOADS["q19_wide_scan"].plan(lake)) == [("succeeded", 100.0, 1000)]


def test_parts_of_a_cent_are_not_lost(spark):
    amounts = {"succeeded": 0.004, "failed": -0.0004, "refunded": 0.29}
    lake = small_marketplace(
        spark,
        payments=[(i, i, 1, day(300), a, s) for s, a in amounts.items() for i in range(1000)],
        bookings=[(i, 1, day(1), 1, "completed") for i in range(1000)],
        listings=[(1, "A", "whole")],
    )
    assert rows(WORKLOADS["q19_wide_scan"].plan(lake)) == [
        ("failed", -0.4, 1000),
        ("refunded", 290.0, 1000),
        ("succeeded", 4.0, 1000),
    ]
    assert rows(WORKLOADS["q06_three_way_join"].plan(lake)) == [("whole", 4.0)]


def test_amounts_that_are_no_numbers_are_refused(spark):
    lake = small_marketplace(spark, payments=[(1, 1, 1, day(1), float("nan"), "succeeded")])
    with pytest.raises(Exception, match="NaN, infinite or too large"):
        WORKLOADS["q19_wide_scan"].plan(lake).collect()
