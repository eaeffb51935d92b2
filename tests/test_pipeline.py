"""Landing, the pipeline end to end, the catalog, and the command lines."""

import json
from pathlib import Path

import pytest

from checks.compare import connect
from roost.operators.quality import DataQualityError
from roost.paths import LakePaths
from roost.plans import catalog, medallion
from roost.schemas import MART_PARTITION, MARTS
from roost.session import fresh_scratch
from roost.sinks.tables import land, write_clean, write_mart
from roost.sources.raw import count_landed, raw_if_landed, read_raw
from roost.sources.stored import read_clean, read_clean_tables
from roost.sources.synthetic_raw import RawData

DAY = "2024-11-30"


@pytest.fixture
def paths(tmp_path):
    return LakePaths.under(str(tmp_path))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    paths = LakePaths.under(str(tmp_path_factory.mktemp("lake")))
    raw = RawData(listings=120).tables(spark)
    return paths, medallion.run(spark, paths, raw, DAY)


def counts(spark, paths, dataset):
    return {str(r.ingest_date): r.records for r in count_landed(spark, paths, dataset).collect()}


def test_land_and_count(spark, paths):
    records = spark.range(25).selectExpr("id", "id + 1000 AS listing_id", "5 AS rating")
    assert land(records, paths, "reviews", DAY) == 25
    assert counts(spark, paths, "reviews") == {DAY: 25}
    assert (Path(paths.bronze) / "reviews" / f"ingest_date={DAY}").is_dir()


def test_landing_keeps_records_as_they_are(spark, paths):
    record = spark.createDataFrame([(1, None, "not-a-date", "  ")], "id INT, listing_id INT, date STRING, comments STRING")
    land(record, paths, "reviews", DAY)
    (line,) = "".join(f.read_text() for f in Path(paths.landed("reviews", DAY)).glob("*.json")).splitlines()
    assert json.loads(line) == {
        "id": 1, "listing_id": None, "date": "not-a-date", "comments": "  ",
    }


def test_landing_again_replaces_that_date_only(spark, paths):
    for day, rows in ((DAY, 5), ("2024-12-01", 7), (DAY, 3)):
        land(spark.range(rows), paths, "listings", day)
    assert counts(spark, paths, "listings") == {DAY: 3, "2024-12-01": 7}


def test_blank_lines_are_not_records(spark, paths):
    folder = Path(paths.landed("listings", DAY))
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"id": 1}\n\n  \t\n{"id": 2}\n')
    assert counts(spark, paths, "listings") == {DAY: 2}


def test_numbers_in_json_are_read_as_text(spark, paths):
    land(spark.sql("SELECT 1L AS id, 12.5D AS price, 3 AS minimum_nights"), paths, "listings", DAY)
    row = read_raw(spark, paths, "listings").first()
    assert (row.price, row.minimum_nights) == ("12.5", "3")


def test_missing_paths_are_optional(spark, paths):
    assert raw_if_landed(spark, paths, "reviews") is None and read_clean_tables(spark, paths) == {}
    with pytest.raises(FileNotFoundError):
        medallion.clean_all(spark, paths)


def test_pipeline_counts_agree(spark, lake):
    paths, outcome = lake
    assert set(outcome.marts) == set(MARTS)
    for name, rows in outcome.marts.items():
        assert spark.read.parquet(paths.mart(name)).count() == rows > 0
    for dataset, rows in outcome.clean.items():
        assert read_clean(spark, paths, dataset).count() == rows < outcome.landed[dataset] + 1
    assert outcome.gates["reviews"].row_count == outcome.clean["reviews"]
    assert "mart booking_conversion" in outcome.as_text()


def test_pipeline_marts_match_sql(spark, lake):
    """The marts made from shared totals, against SQL over the clean files."""
    paths, _ = lake
    sql = connect("/nowhere")
    for dataset in ("listings", "reviews", "bookings", "transactions"):
        sql.execute(
            f"CREATE VIEW {dataset} AS SELECT * FROM read_parquet('{paths.clean(dataset)}/**/*.parquet', hive_partitioning = true)"
        )
    expected = sql.execute(
        "SELECT l.id, count(*) FROM listings l JOIN reviews r ON l.id = r.listing_id GROUP BY 1"
    ).fetchall()
    found = spark.read.parquet(paths.mart("reviews_per_listing")).select("id", "num_reviews").collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    expected = sql.execute(
        """SELECT l.id, b.checkin_month, count(*), CAST(sum(b.nights) AS BIGINT),
             CAST(sum(CAST(b.amount AS DECIMAL(18,2))) AS DOUBLE)
           FROM listings l JOIN bookings b ON l.id = b.listing_id WHERE status = 'completed' GROUP BY 1, 2"""
    ).fetchall()
    found = spark.read.parquet(paths.mart("revenue_by_listing_month")).select(
        "id", "checkin_month", "num_bookings", "total_nights", "total_revenue"
    )
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_running_again_changes_nothing(spark, lake):
    paths, outcome = lake
    before = {m: sorted(map(tuple, spark.read.parquet(paths.mart(m)).collect())) for m in MARTS}
    again = medallion.run(spark, paths, RawData(listings=120).tables(spark), DAY)
    assert (again.landed, again.clean, again.marts) == (outcome.landed, outcome.clean, outcome.marts)
    for mart, rows in before.items():
        assert sorted(map(tuple, spark.read.parquet(paths.mart(mart)).collect())) == rows


def test_clean_tables_are_partitioned_without_ingest_date(spark, lake):
    paths, _ = lake
    tables = read_clean_tables(spark, paths)
    assert tables["reviews"].columns[-1] == "review_month"
    assert all("ingest_date" not in df.columns for df in tables.values())
    assert list(Path(paths.clean("transactions")).glob("txn_date=*"))


def test_small_totals_are_not_spread_over_every_part_of_a_shuffle(spark, lake, setting):
    """Parts times parts of blocks are written otherwise, however few rows there are."""
    paths, before = lake
    setting(spark__sql__shuffle__partitions="61")
    scratch = Path(fresh_scratch(spark, "any")).parent
    kept_before = set(scratch.glob("totals-*"))
    context = spark.sparkContext
    context.setJobGroup("publish", "marts")
    try:
        assert medallion.publish_all(spark, paths) == before.marts
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("publish")]
    stages = [tracker.getStageInfo(s) for job in jobs for s in job.stageIds]
    tasks = [stage.numTasks for stage in stages if stage is not None and stage.numCompletedTasks]
    assert tasks and 61 not in tasks
    assert set(scratch.glob("totals-*")) == kept_before


def test_only_listings_and_reviews(spark, paths):
    raw = RawData(listings=20).tables(spark)
    outcome = medallion.run(spark, paths, {d: raw[d] for d in ("listings", "reviews")}, DAY)
    assert set(outcome.marts) == {"reviews_per_listing", "avg_rating_per_listing", "reviews_per_neighbourhood"}
    medallion.show_samples(spark, paths, outcome.marts, 2)


def test_failed_gate_writes_no_mart(spark, paths):
    raw = RawData(listings=20).tables(spark)
    with pytest.raises(DataQualityError, match="empty"):
        medallion.run(spark, paths, {"listings": raw["listings"], "reviews": raw["reviews"].limit(0)}, DAY)
    assert not Path(paths.gold).exists()


def test_writes_replace_tables_unless_asked_for_partitions(spark, paths):
    def bookings(*months):
        return spark.createDataFrame([(i, m) for i, m in enumerate(months)], "booking_id BIGINT, checkin_month STRING")

    assert write_clean(bookings("2024-01", "2024-02", "2024-02"), paths, "bookings") == 3
    # booking 0 has moved; its old month keeps no row, its new one is replaced
    assert write_clean(bookings("2024-02"), paths, "bookings", only_partitions=True) == 1
    assert read_clean(spark, paths, "bookings").count() == 1
    assert [f.name for f in Path(paths.clean("bookings")).glob("checkin_month=*")] == ["checkin_month=2024-02"]
    assert write_clean(bookings("2024-03"), paths, "bookings") == 1
    assert read_clean(spark, paths, "bookings").count() == 1
    for months in (("2024-01", "2024-02"), ("2024-02",)):
        earned = bookings(*months).selectExpr("booking_id AS id", "checkin_month", "1.0D AS total_revenue")
        assert write_mart(earned, paths, "revenue_by_listing_month") == len(months)
    assert spark.read.parquet(paths.mart("revenue_by_listing_month")).count() == 1


def test_a_booking_landed_again_with_other_dates_counts_once(spark, paths):
    raw = RawData(listings=20).tables(spark)
    booking = "1L AS booking_id, {}L AS listing_id, 5L AS guest_id, '{}' AS checkin_date, '{}' AS checkout_date"
    rest = "'2' AS nights, '100.0' AS amount, 'completed' AS status"
    listing = raw["listings"].where("price > 0").first().id
    for first, last in (("2024-01-10", "2024-01-12"), ("2024-02-10", "2024-02-12")):
        raw["bookings"] = spark.sql(f"SELECT {booking.format(listing, first, last)}, {rest}")
        outcome = medallion.run(spark, paths, raw, DAY)
        assert outcome.clean["bookings"] == read_clean(spark, paths, "bookings").count() == 1
    months = spark.read.parquet(paths.mart("revenue_by_listing_month")).collect()
    assert [(m.checkin_month, m.total_revenue) for m in months] == [("2024-02", 100.0)]


def test_incremental_loads_leave_no_stale_row(spark, paths):
    def bookings(**months):
        rows = [(int(k[1:]), m, i) for i, (k, m) in enumerate(months.items())]
        return spark.createDataFrame(rows, "booking_id BIGINT, checkin_month STRING, nights INT")

    def stored():
        return {r.booking_id: r.checkin_month for r in spark.read.parquet(paths.clean("bookings")).collect()}

    write_clean(bookings(b1="2024-01", b2="2024-01", b3="2024-02", b4="2024-03", b5="2024-04"), paths, "bookings")
    untouched = sorted(f.name for f in Path(paths.clean("bookings"), "checkin_month=2024-04").iterdir())
    assert write_clean(bookings(b1="2024-02", b4="2024-05", b6="2024-02"), paths, "bookings", only_partitions=True) == 3
    assert stored() == {1: "2024-02", 2: "2024-01", 4: "2024-05", 5: "2024-04", 6: "2024-02"}
    assert not Path(paths.clean("bookings"), "checkin_month=2024-03").exists()
    assert sorted(f.name for f in Path(paths.clean("bookings"), "checkin_month=2024-04").iterdir()) == untouched
    # the same load again changes nothing, an empty one neither
    write_clean(bookings(b1="2024-02", b4="2024-05", b6="2024-02"), paths, "bookings", only_partitions=True)
    write_clean(bookings(b1="2024-02").limit(0), paths, "bookings", only_partitions=True)
    assert stored() == {1: "2024-02", 2: "2024-01", 4: "2024-05", 5: "2024-04", 6: "2024-02"}


def test_a_half_written_table_is_not_there(spark, paths):
    write_clean(spark.createDataFrame([(1, "n")], "id BIGINT, name STRING"), paths, "listings")
    land(spark.range(3), paths, "listings", DAY)
    land(spark.range(5), paths, "listings", "2024-12-01")
    assert set(read_clean_tables(spark, paths)) == {"listings"}
    Path(paths.clean("listings"), "_SUCCESS").unlink()
    (Path(paths.landed("listings", DAY)) / "_temporary").mkdir()
    assert read_clean_tables(spark, paths) == {} and catalog.register(spark, paths, "half_test") == []
    assert raw_if_landed(spark, paths, "listings").count() == 5
    (Path(paths.landed("listings", "2024-12-01")) / "_temporary").mkdir()
    assert raw_if_landed(spark, paths, "listings") is None


def test_a_table_follows_the_lake_it_is_registered_from(spark, tmp_path):
    """Two roots, one of them with a quote in its name, and a month that vanishes."""
    row = "1L AS id, 'n' AS name, 'a' AS neighbourhood, 1L AS num_bookings, 2L AS total_nights, 3.0D AS total_revenue"
    table, found = "moved_test.gold_revenue_by_listing_month", []
    lakes = [LakePaths.under(str(tmp_path / name)) for name in ("one", "an'other")]
    for lake, months in zip(lakes, (["2024-01", "2024-02"], ["2024-03"])):
        mart = spark.createDataFrame([(m,) for m in months], "checkin_month STRING")
        write_mart(mart.selectExpr(*row.split(", "), "checkin_month"), lake, "revenue_by_listing_month")
        assert catalog.register(spark, lake, "moved_test") == [table]
        found.append(sorted(r.checkin_month for r in spark.table(table).collect()))
    assert found == [["2024-01", "2024-02"], ["2024-03"]]
    assert spark.read.parquet(lakes[0].mart("revenue_by_listing_month")).count() == 2
    catalog.register(spark, lakes[0], "moved_test")
    from roost import files

    files.remove(spark, f"{lakes[0].mart('revenue_by_listing_month')}/checkin_month=2024-01")
    catalog.refresh(spark, table)
    assert [r.checkin_month for r in spark.table(table).collect()] == ["2024-02"]
    assert [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()] == ["checkin_month=2024-02"]
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} (id BIGINT) USING PARQUET")
    with pytest.raises(ValueError, match="owns its files"):
        catalog.register(spark, lakes[0], "moved_test")


def test_months_of_a_mart_are_few_sorted_files(spark, lake):
    import pyarrow.parquet as pq

    paths, _ = lake
    files = list(Path(paths.mart("revenue_by_listing_month")).rglob("*.parquet"))
    assert len(files) == len({f.parent for f in files}) == 12
    for file in files:
        revenue = pq.ParquetFile(file).read(columns=["total_revenue"]).column(0).to_pylist()
        assert revenue == sorted(revenue, reverse=True)


def test_catalog_answers_like_the_files(spark, lake):
    from tests.conftest import plan_of

    paths, outcome = lake
    tables = catalog.register(spark, paths, "lake_test")
    assert len(tables) == 10 == len(catalog.declarations(paths))
    for mart, rows in outcome.marts.items():
        assert spark.table(f"lake_test.gold_{mart}").count() == rows
    for dataset, rows in outcome.clean.items():
        assert spark.table(f"lake_test.silver_{dataset}").count() == rows
    earners = catalog.ask(spark, "sql_month_top_earners", "lake_test", month="2024-06")
    assert 0 < earners.count() <= 10
    assert "PartitionFilters: [isnotnull(checkin_month" in plan_of(earners)
    for name, query in catalog.QUERIES.items():
        month = {"month": "2024-06"} if ":month" in query.sql else {}
        by_name = catalog.ask(spark, name, "lake_test", **month).collect()
        assert by_name == query.run(spark.read.parquet(paths.mart(query.mart)), **month).collect()


def test_new_partitions_are_found_after_refresh(spark, paths):
    def mart(*months):
        row = "1L AS id, 'n' AS name, 'a' AS neighbourhood, 1L AS num_bookings, 2L AS total_nights, 3.0D AS total_revenue"
        return spark.createDataFrame([(m,) for m in months], "checkin_month STRING").selectExpr(*row.split(", "), "checkin_month")

    write_mart(mart("2024-01"), paths, "revenue_by_listing_month")
    assert catalog.register(spark, paths, "refresh_test") == ["refresh_test.gold_revenue_by_listing_month"]
    table = "refresh_test.gold_revenue_by_listing_month"
    write_mart(mart("2024-01", "2024-02"), paths, "revenue_by_listing_month")
    catalog.refresh(spark, table)
    assert spark.table(table).count() == 2


def test_partitioned_tables_are_the_declared_ones():
    assert catalog.partitioned_tables("d") == [
        "d.silver_reviews", "d.silver_bookings", "d.silver_transactions", "d.gold_revenue_by_listing_month",
    ]
    assert set(MART_PARTITION) == {"revenue_by_listing_month"}


def test_paths():
    paths = LakePaths("s3://a/bronze/", "s3://a/silver", "s3://b/gold")
    assert paths.landed("listings", DAY) == f"s3://a/bronze/listings/ingest_date={DAY}"
    assert paths.clean("reviews") == "s3://a/silver/reviews"
    assert paths.mart("m") == "s3://b/gold/m"


def test_command_lines(spark, tmp_path, monkeypatch, capsys):
    """The jobs as a user starts them, in this session."""
    from roost.jobs import generate_raw, medallion as job, register_tables

    for module in (generate_raw, job, register_tables):
        monkeypatch.setattr(module, "build_session", lambda *_: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    generate_raw.main(["--out", f"{tmp_path}/raw", "--listings", "15", "--datasets", "listings", "reviews"])
    assert "listings: 15 records" in capsys.readouterr().out
    job.main(["--root", f"{tmp_path}/lake", "--generate", "--listings", "40", "--ingest-date", DAY,
              "--gate", "reviews", "transactions"])
    shown = capsys.readouterr().out
    assert "clean listings: 40 rows" in shown and "passed the gate transactions" in shown
    bases = [f"--{layer}={tmp_path}/lake/{layer}" for layer in ("bronze", "silver", "gold")]
    job.main([*bases, "--samples", "1"])
    assert "landed" not in capsys.readouterr().out
    register_tables.main(["--root", f"{tmp_path}/lake", "--database", "cli_test"])
    assert "sql_weakest_conversion" in capsys.readouterr().out
    register_tables.main(["--root", "/x", "--print-ddl"])
    assert capsys.readouterr().out.count("CREATE TABLE") == 10
    with pytest.raises(SystemExit):
        job.main(["--bronze", "x"])
