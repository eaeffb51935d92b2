"""The gate: what passes, what stops, and in which order."""

import random

import pytest

from roost.measure.scans import shuffled_bytes
from roost.operators.quality import GATES, DataQualityError, Gate, check_reviews


def reviews(spark, *rows):
    return spark.createDataFrame(list(rows), "id BIGINT, listing_id BIGINT, rating INT")


def test_clean_table_passes(spark):
    report = check_reviews(reviews(spark, (1, 10, 5), (2, 10, 1)))
    assert (report.row_count, report.distinct_ids, report.duplicate_ids) == (2, 2, 0)


@pytest.mark.parametrize(
    "rows, reason",
    [
        ([], "empty"),
        ([(1, 10, 5), (1, 11, 4)], "duplicate_ids"),
        ([(1, None, 5)], "null_keys"),
        ([(None, 10, 5), (None, 10, 5), (1, 10, 5)], "2 rows counted as null_keys"),
        ([(1, 10, 0)], "out_of_range_ratings"),
        ([(1, 10, 6)], "out_of_range_ratings"),
        ([(1, 10, 9), (1, None, 9)], "duplicate_ids"),
    ],
)
def test_first_broken_rule_stops(spark, rows, reason):
    with pytest.raises(DataQualityError, match=reason):
        check_reviews(reviews(spark, *rows))


def test_null_rating_is_counted_but_passes(spark):
    assert check_reviews(reviews(spark, (1, 10, None))).counts["null_ratings"] == 1


def test_other_tables(spark):
    assert set(GATES) == {"listings", "reviews", "bookings", "transactions"}
    gate = Gate("t", ("k",), {"negative": "v < 0"})
    with pytest.raises(DataQualityError, match="t: 1 rows counted as negative"):
        gate.check(spark.createDataFrame([(1, -1), (2, 1)], "k INT, v INT"))


def test_one_scan(spark):
    from tests.conftest import plan_of

    measured = GATES["reviews"].measure(spark.read.parquet("/root/testdata/sf0.01/events.parquet")
        .selectExpr("event_id AS id", "user_id AS listing_id", "1 AS rating"))
    assert plan_of(measured).count("FileScan") == 1


EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**63 - 1, -(2**63), 2**31]


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_count_like_a_set(spark, seed):
    """Around the borders of buckets, below zero, repeated, and without a key."""
    draw = random.Random(seed)
    keys = [draw.choice([*EDGES, None, draw.randrange(-70_000, 70_000)]) for _ in range(400)]
    if seed == 2:
        keys = [None, None]
    rows = spark.createDataFrame([(k, 1) for k in keys], "k BIGINT, v INT").repartition(5)
    for dense in (True, False):
        found = Gate("t", ("k",), {"ones": "v = 1"}, dense=dense).measure(rows).first()
        known = [k for k in keys if k is not None]
        assert found.row_count == found.ones == len(keys)
        assert found.distinct_ids == len(set(known))
        assert found.duplicate_ids == len(known) - len(set(known))
        assert found.null_keys == len(keys) - len(known)


def test_bitmaps_over_no_rows_and_text_keys(spark):
    gate = Gate("t", ("k",), dense=True)
    assert gate.measure(spark.createDataFrame([], "k BIGINT")).first().asDict() == {
        "row_count": 0, "distinct_ids": 0, "duplicate_ids": 0, "null_keys": 0,
    }
    assert gate.measure(spark.createDataFrame([("a",), ("a",), ("b",)], "k STRING")).first().distinct_ids == 2


def test_numbered_keys_are_sent_as_bits(spark, tmp_path):
    """A third of the rows repeat one key; the shuffle is an order smaller than one of keys."""
    path = str(tmp_path / "rows")
    spark.range(600_000).selectExpr(
        "IF(id % 3 = 0, 7, id) AS id", "id AS listing_id", "1 AS rating"
    ).write.parquet(path)
    sent, counts = {}, {}
    for dense in (True, False):
        measured = Gate("t", ("id", "listing_id"), dense=dense).measure(spark.read.parquet(path))
        counts[dense] = measured.collect()
        sent[dense] = shuffled_bytes(measured)
    assert counts[True] == counts[False]
    assert 0 < sent[True] * 10 < sent[False]
