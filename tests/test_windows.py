"""The distributed running total and rank against plain Python."""

import random
from itertools import accumulate

import pytest

from roost.operators.windows import SLICES, cumulative_share, global_rank, sliced, top_per_group
from tests.conftest import plan_of


def expected(values):
    ordered = sorted(values, key=lambda kv: (-kv[1], kv[0]))
    totals = accumulate(v for _, v in ordered)
    grand = sum(v for _, v in ordered)
    return {k: (v, total, grand) for (k, v), total in zip(ordered, totals)}


def tied(count):
    """A third of the rows share one value."""
    pick = random.Random(3)
    return [(k, 500 if k % 3 == 0 else pick.randint(1, 1000)) for k in range(count)]


@pytest.mark.parametrize("values", [[(1, 5)], [(1, 0), (2, 0)], tied(5000)], ids=["one", "zeros", "tied"])
def test_equals_brute_force(spark, values):
    df = spark.createDataFrame(values, "k BIGINT, v BIGINT")
    found = {r.k: (r.v, int(r.cum), int(r.grand)) for r in cumulative_share(df, "v", "k").collect()}
    assert found == expected(values)


def test_slices_share_the_rows(spark):
    """No slice holds the tied third, though one value does."""
    df = spark.createDataFrame(tied(20000), "k BIGINT, v BIGINT")
    sizes = [r["count"] for r in sliced(df, "v", "k").groupBy("_slice").count().collect()]
    assert max(sizes) < 20000 / 40 and len(sizes) < 2 * SLICES**2


def test_slices_follow_the_order(spark):
    df = spark.createDataFrame(tied(3000) + [(-1, None), (-2, 2**62)], "k BIGINT, v BIGINT")
    rows = [(r._slice, -r.v, r.k) for r in sliced(df, "v", "k").collect() if r.v is not None]
    assert sorted(rows) == sorted(rows, key=lambda r: r[1:])


def jobs_of(spark, action):
    spark.sparkContext.setJobGroup(action.__name__, "")
    action()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(action.__name__)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(jobs)


def test_building_the_plan_runs_nothing(spark):
    df = spark.createDataFrame(tied(300), "k BIGINT, v BIGINT")

    def plan():
        cumulative_share(df, "v", "k").schema
        global_rank(df, "v", "rank").schema

    assert jobs_of(spark, plan) == 0


def test_both_uses_of_the_slices_read_one_shuffle(spark):
    """Were slices worked out twice, a retried task could cut the order at other borders."""
    df = spark.createDataFrame(tied(5000), "k BIGINT, v BIGINT")
    shares = cumulative_share(df, "v", "k")
    shares.collect()
    assert "ReusedExchange" in plan_of(shares)


RANKED = {
    "one": [(1, 5)],
    "none": [],
    "all tied": [(k, 7) for k in range(3000)],
    "a third tied": tied(4000),
    "ties on every border": [(k, k % 64) for k in range(6400)],
    "nulls and extremes": [(k, None) for k in range(50)] + [(k, 2**62) for k in range(30)] + [(0, -(2**63))],
}


@pytest.mark.parametrize("values", RANKED.values(), ids=RANKED)
def test_rank_over_everything(spark, values):
    df = spark.createDataFrame(values, "k BIGINT, v BIGINT").repartition(5)
    low = -(2**64)
    place = {}
    for at, v in enumerate(sorted((low if v is None else v for _, v in values), reverse=True), 1):
        place.setdefault(v, at)
    found = sorted((r.k, low if r.v is None else r.v, r.rank) for r in global_rank(df, "v", "rank").collect())
    assert found == sorted((k, low if v is None else v, place[low if v is None else v]) for k, v in values)


def test_no_task_gathers_all_ranked_rows(spark):
    """Only what subqueries count up meets in one task."""
    df = spark.range(5000).selectExpr("id AS k", "id % 70 AS v")
    plan = plan_of(global_rank(df, "v", "rank"))
    one_task = [line.partition("Exchange")[0] for line in plan.split("\n") if "SinglePartition" in line]
    assert one_task and all(":" in before for before in one_task)


def test_sums_beyond_a_bigint(spark):
    df = spark.createDataFrame([(k, 2**62) for k in range(5)], "k BIGINT, v BIGINT")
    found = cumulative_share(df.repartition(3), "v", "k")
    assert {int(r.grand) for r in found.collect()} == {5 * 2**62}


def test_top_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "id AS v")
    top = top_per_group(df, "g", "v", 2, "rk")
    assert sorted(tuple(r) for r in top.collect()) == [
        (0, 996, 2), (0, 999, 1), (1, 994, 2), (1, 997, 1), (2, 995, 2), (2, 998, 1),
    ]
    plan = plan_of(df.transform(top_per_group, "g", "v", 2, "rk"))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
