"""Files of the layouts: sorted, sized, skew-proof, whole."""

import json
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from roost.sinks.layout import (
    TUNED,
    files_for,
    places,
    rows_per_key,
    write_csv,
    write_plain,
    write_tuned,
)
from roost.sources import synthetic
from roost.sources.synthetic import Scale, stored_bytes


def parquet_files(path):
    return sorted(Path(path).rglob("*.parquet"))


def table_rows(file, columns):
    table = pq.ParquetFile(file).read(columns=columns)
    return list(zip(*(table.column(c).to_pylist() for c in columns)))


@pytest.mark.parametrize("dataset", ["transactions", "bookings", "reviews"])
def test_files_are_sorted_and_partitioned(spark, tmp_path, dataset):
    scale = Scale(30_000, 20_000, 20_000, 100)
    source = scale.tables(spark)[dataset]
    write_tuned(source, str(tmp_path), TUNED[dataset], rows_per_file=4_000)
    files = parquet_files(tmp_path)
    order = [*TUNED[dataset].order, TUNED[dataset].unique]
    for file in files:
        rows = table_rows(file, order)
        assert rows == sorted(rows)
        assert len(rows) <= 4_000 * 1.5
    assert len({f.parent.name for f in files}) == 24
    assert files_for(scale.rows(dataset), 4_000) <= len(files) <= files_for(scale.rows(dataset), 4_000) + 24
    stored = spark.read.parquet(str(tmp_path))
    assert sorted(stored.columns) == sorted(TUNED[dataset].columns)
    assert stored.count() == scale.rows(dataset)


def test_hot_month_is_shared_by_writers(spark, tmp_path):
    """A third of the rows are equal but for their key; they still spread over files."""
    ids = spark.range(30_000)
    rows = synthetic.transactions(ids, 100, 100).selectExpr(
        "* EXCEPT (txn_date, txn_month, status, amount)",
        "IF(txn_id % 3 = 0, DATE '2023-05-01', txn_date) AS txn_date",
        "IF(txn_id % 3 = 0, '2023-05', txn_month) AS txn_month",
        "IF(txn_id % 3 = 0, 'failed', status) AS status",
        "IF(txn_id % 3 = 0, 9.0D, amount) AS amount",
    )
    write_tuned(rows, str(tmp_path), TUNED["transactions"], rows_per_file=2_000)
    hot = [len(table_rows(f, ["txn_id"])) for f in parquet_files(tmp_path) if "2023-05" in str(f)]
    assert len(hot) >= 5 and max(hot) <= 2_000
    assert spark.read.parquet(str(tmp_path)).select("txn_id").distinct().count() == 30_000


def test_small_months_share_a_writer(spark, tmp_path):
    scale = Scale(5_000, 10, 10, 10)
    write_tuned(scale.tables(spark)["transactions"], str(tmp_path), TUNED["transactions"])
    assert len(parquet_files(tmp_path)) == 24


def metered(df, counter):
    """The rows of ``df``, each added to ``counter`` when it is made."""

    def run(batches):
        for batch in batches:
            counter.add(len(batch))
            yield batch

    return df.mapInPandas(run, df.schema)


@pytest.mark.parametrize("known", [True, False])
def test_the_input_is_read_once(spark, tmp_path, known):
    """With known counts; without them its day column is read once more. A third is one month."""
    counter = spark.sparkContext.accumulator(0)
    rows = synthetic.transactions(spark.range(9_000), 100, 100).selectExpr(
        "* EXCEPT (txn_date, txn_month)",
        "IF(txn_id % 3 = 0, DATE '2023-05-01', txn_date) AS txn_date",
        "IF(txn_id % 3 = 0, '2023-05', txn_month) AS txn_month",
    )
    table = TUNED["transactions"]
    counts = rows_per_key(rows, table) if known else None
    write_tuned(metered(rows, counter), str(tmp_path), table, counts, rows_per_file=1_000)
    assert counter.value == 9_000 * (1 if known else 2)
    files = parquet_files(tmp_path)
    assert sum("2023-05" in str(f) for f in files) >= 3
    for file in files:
        found = table_rows(file, ["txn_date", "status", "amount", "txn_id"])
        assert found == sorted(found) and len(found) <= 1_000
    assert spark.read.parquet(str(tmp_path)).count() == 9_000


def test_counts_may_be_stale(spark, tmp_path):
    rows = synthetic.reviews(spark.range(4_000), 10)
    counts = dict(list(rows_per_key(rows, TUNED["reviews"]).items())[:200])
    write_tuned(rows, str(tmp_path), TUNED["reviews"], counts, rows_per_file=100)
    assert spark.read.parquet(str(tmp_path)).count() == 4_000


def test_null_days_and_empty_tables(spark, tmp_path):
    rows = synthetic.reviews(spark.range(90), 10).selectExpr(
        "* EXCEPT (review_date, review_month)",
        "IF(review_id % 3 = 0, NULL, review_date) AS review_date",
        "IF(review_id % 3 = 0, NULL, review_month) AS review_month",
    )
    write_tuned(rows, str(tmp_path / "some"), TUNED["reviews"], rows_per_file=10)
    assert spark.read.parquet(str(tmp_path / "some")).where("review_date IS NULL").count() == 30
    write_tuned(rows.limit(0), str(tmp_path / "none"), TUNED["reviews"])
    assert parquet_files(tmp_path / "none") == []


def test_places_fill_writers_in_order():
    counts = {"b": 30, "a": 60, "d": 250, "c": 20, "e": 1, None: 5}
    found, writers = places(counts, 100)
    assert found == [(None, 0, 1), ("a", 0, 1), ("b", 0, 1), ("c", 1, 1), ("d", 2, 3), ("e", 5, 1)]
    assert writers == 6
    assert places({}, 100) == ([], 0) and places({"a": 250}, 100) == ([("a", 0, 3)], 3)


def test_writing_again_replaces_all(spark, tmp_path):
    table = TUNED["reviews"]
    for rows in (5_000, 40):
        write_tuned(synthetic.reviews(spark.range(rows), 10), str(tmp_path), table)
    assert spark.read.parquet(str(tmp_path)).count() == 40


def test_plain_keeps_every_column(spark, tmp_path):
    source = synthetic.bookings(spark.range(1_000), 10)
    write_plain(source, str(tmp_path / "few"), files=2)
    write_plain(source, str(tmp_path / "all"))
    assert len(parquet_files(tmp_path / "few")) == 2
    for name in ("few", "all"):
        assert spark.read.parquet(str(tmp_path / name)).columns == source.columns


def test_csv_has_headers(spark, tmp_path):
    source = synthetic.listings(spark.range(50))
    write_csv(source, str(tmp_path / "c"), files=1)
    (file,) = Path(tmp_path / "c").glob("*.csv")
    assert file.read_text().splitlines()[0].split(",") == source.columns
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 50


def test_size_on_disk(spark, tmp_path):
    write_plain(synthetic.listings(spark.range(500)), str(tmp_path / "t"), files=3)
    expected = sum(f.stat().st_size for f in parquet_files(tmp_path / "t"))
    assert stored_bytes(spark, str(tmp_path / "t")) == expected


def test_compare_layouts_job(spark, tmp_path, monkeypatch):
    from roost.jobs import compare_layouts

    scale = Scale(3_000, 1_000, 1_000, 50)
    result = compare_layouts.run(spark, str(tmp_path), scale, runs=1, with_csv=True)
    assert result["query_count"] == 22
    assert result["bytes"]["plain"] > result["bytes"]["tuned"] > 0
    saved = "\n".join(r.value for r in spark.read.text(f"{tmp_path}/report/json").collect())
    assert json.loads(saved) == json.loads(json.dumps(result))
    assert spark.read.csv(f"{tmp_path}/csv_transactions", header=True).count() == 3_000

    def must_not_build(*_):
        raise AssertionError("built again")

    monkeypatch.setattr(compare_layouts, "build", must_not_build)
    assert compare_layouts.is_built(spark, str(tmp_path))
    again = compare_layouts.run(spark, str(tmp_path), scale, runs=1)
    assert again["bytes"] == result["bytes"]
    with pytest.raises(ValueError, match="--rebuild"):
        compare_layouts.run(spark, str(tmp_path), Scale(4_000, 1_000, 1_000, 50), runs=1)
    next(Path(tmp_path, "tuned", "reviews").rglob("*.parquet")).unlink()
    with pytest.raises(ValueError, match="manifest"):
        compare_layouts.run(spark, str(tmp_path), scale, runs=1)
