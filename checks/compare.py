"""Run registered queries and their SQL side by side and compare whole results.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        file = Path(sf_dir) / f"{table}.parquet"
        if file.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(found: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Values must be equal exactly, doubles included."""
    cursor = connection.execute(sql)
    columns = [c[0] for c in cursor.description]
    if sorted(columns) != sorted(found.columns):
        return f"columns {sorted(found.columns)} instead of {sorted(columns)}"
    expected = _rows(columns, cursor.fetchall())
    actual = _rows(found.columns, [tuple(r) for r in found.collect()])
    if len(expected) != len(actual):
        return f"{len(actual)} rows instead of {len(expected)}"
    for want, got in zip(expected, actual):
        if want != got:
            return f"row {got} instead of {want}"
    return None if expected else "no rows"


def main(argv: list[str]) -> int:
    from checks.oracle import QUERIES
    from roost.plans.registry import REGISTRY

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    wrong = sorted(set(REGISTRY) ^ set(QUERIES))
    for name in wrong:
        print(f"{name}: on one side only")
    for name in argv[1:] or REGISTRY:
        started = time.perf_counter()
        problem = difference(REGISTRY[name](spark, sf_dir), connection, QUERIES[name])
        print(f"{name}: {problem or 'equal'} ({time.perf_counter() - started:.2f}s)", flush=True)
        if problem:
            wrong.append(name)
    print(f"{len(wrong)} wrong of {len(REGISTRY)}")
    return 1 if wrong else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
