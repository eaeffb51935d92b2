"""Facts stored in buckets of the key they are joined on."""

from dataclasses import replace

import pytest

from roost.plans import layouts
from roost.plans.workloads import WORKLOADS
from roost.sinks.layout import ROWS_PER_BUCKET, TUNED, buckets_for, declare_bucketed, is_even
from roost.sources import mapped, synthetic
from roost.sources.synthetic import START, Scale
from roost.plans.marketplace import Marketplace
from tests.conftest import plan_of

JOINED = ["q05_txn_booking_join", "q06_three_way_join", "q17_conversion"]


@pytest.fixture(scope="module")
def lake(spark):
    tables = Scale(20_000, 6_000, 500, 300).tables(spark)
    return Marketplace(tables["listings"], tables["bookings"], tables["reviews"], tables["transactions"], START)


@pytest.fixture(scope="module")
def bucketed(spark, lake, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("buckets"))
    assert layouts.write_bucketed_layout(spark, base, "bucketed_test", lake, 8)
    yield base, layouts.with_buckets(spark, lake, "bucketed_test")
    spark.sql("DROP DATABASE bucketed_test CASCADE")


@pytest.mark.parametrize("key", JOINED)
def test_facts_meet_without_a_shuffle(bucketed, setting, key):
    """What is shuffled is what comes out of the join, per nights, room type or listing."""
    setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    plan = plan_of(WORKLOADS[key].plan(bucketed[1]))
    assert "Bucketed: true" in plan or "SelectedBucketsCount: 8 out of 8" in plan
    lines = plan.split("\n")
    join = next(i for i, line in enumerate(lines) if "Join [booking_id" in line)
    depth = lines[join].index("Join")
    below = []
    for line in lines[join + 1 :]:
        if len(line) - len(line.lstrip(" :+-*()0123456789")) <= depth - 12:
            break
        below.append(line)
    assert sum("Scan parquet" in line for line in below) == 2
    assert not any("Exchange" in line for line in below)


@pytest.mark.parametrize("key", JOINED)
def test_rows_are_those_of_the_plain_tables(lake, bucketed, key):
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(WORKLOADS[key].plan(bucketed[1])) == rows(WORKLOADS[key].plan(lake)) != []


def test_months_are_still_pruned(bucketed):
    plan = plan_of(WORKLOADS["q05_txn_booking_join"].plan(bucketed[1]))
    assert "txn_month" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]


def test_stored_buckets_are_declared_in_another_catalog(spark, lake, bucketed):
    base, _ = bucketed
    spark.sql("CREATE DATABASE again")
    for dataset in layouts.BUCKETED:
        table = TUNED[dataset]
        schema = spark.table(f"bucketed_test.{dataset}").schema.toDDL()
        declare_bucketed(spark, f"again.{dataset}", f"{base}/{dataset}", schema, table, "booking_id", 8)
    found = layouts.with_buckets(spark, lake, "again")
    key = "q05_txn_booking_join"
    assert sorted(map(repr, WORKLOADS[key].plan(found).collect())) == sorted(map(repr, WORKLOADS[key].plan(lake).collect()))
    spark.sql("DROP DATABASE again CASCADE")


def test_a_hot_booking_is_not_put_into_one_bucket(spark, lake, tmp_path):
    hot = lake.payments.selectExpr("* EXCEPT (booking_id)", "IF(txn_id % 3 = 0, 5L, booking_id) AS booking_id")
    assert is_even(lake.payments, "booking_id", 16) and not is_even(hot, "booking_id", 16)
    assert is_even(hot.limit(0), "booking_id", 16)
    skewed = replace(lake, payments=hot)
    assert not layouts.write_bucketed_layout(spark, str(tmp_path), "never", skewed, 16)
    assert not spark.catalog.databaseExists("never")


def test_buckets_follow_the_rows(spark, lake, tmp_path, monkeypatch):
    """A task's bucket stays as it is while the tables grow, and both tables are cut alike."""
    monkeypatch.setattr(layouts, "buckets_for", lambda rows, least: buckets_for(rows, least, 1_000))
    assert layouts.write_bucketed_layout(spark, str(tmp_path), "more_buckets", lake, 4)
    needed = -(-max(lake.payments.count(), lake.bookings.count()) // 1_000)
    assert needed > 4
    for dataset in layouts.BUCKETED:
        detail = spark.sql(f"DESCRIBE EXTENDED more_buckets.{dataset}").where("col_name = 'Num Buckets'")
        assert int(detail.first()["data_type"]) == needed
    key = "q06_three_way_join"
    found = WORKLOADS[key].plan(layouts.with_buckets(spark, lake, "more_buckets"))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, WORKLOADS[key].plan(lake).collect()))
    spark.sql("DROP DATABASE more_buckets CASCADE")
    for rows in (0, 10**6, 10**8, 10**11):
        assert rows / buckets_for(rows, 4) <= ROWS_PER_BUCKET
