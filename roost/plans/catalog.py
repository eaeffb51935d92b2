"""Clean tables and marts as external tables, for SQL by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roost.files import is_committed, qualified
from roost.paths import LakePaths
from roost.plans.analyst_sql import QUERIES
from roost.schemas import CLEAN, CLEAN_PARTITION, MART_PARTITION, MARTS

DATABASE = "stay_lake"


def _declaration(table: str, columns: str, partition: str | None, path: str) -> str:
    every = f"{columns}, {partition}" if partition else columns
    split = f" PARTITIONED BY ({partition.split()[0]})" if partition else ""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    return f"CREATE TABLE IF NOT EXISTS {table} ({every}) USING PARQUET{split} LOCATION '{place}'"


def declarations(paths: LakePaths, database: str = DATABASE) -> dict[str, str]:
    """The statement that declares each table, by table name."""
    clean = {
        f"{database}.silver_{d}": (columns, CLEAN_PARTITION[d], paths.clean(d))
        for d, columns in CLEAN.items()
    }
    marts = {
        f"{database}.gold_{m}": (columns, MART_PARTITION.get(m), paths.mart(m))
        for m, columns in MARTS.items()
    }
    return {table: _declaration(table, *parts) for table, parts in (clean | marts).items()}


def _stored(spark: SparkSession, paths: LakePaths, database: str) -> set[str]:
    """Names of the tables that were written to the end."""
    return {table for table, path in places(paths, database).items() if is_committed(spark, path)}


def places(paths: LakePaths, database: str = DATABASE) -> dict[str, str]:
    """Where the files of each table lie."""
    clean = {f"{database}.silver_{d}": paths.clean(d) for d in CLEAN}
    return clean | {f"{database}.gold_{m}": paths.mart(m) for m in MARTS}


def _release(spark: SparkSession, table: str, path: str) -> None:
    """Forget a table that points elsewhere, so that it can be declared where it is now.

    A new location alone would leave its partitions where they were. Only the entry goes,
    the files stay; a table that owns its files is not touched.
    """
    if not spark.catalog.tableExists(table):
        return
    known = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if qualified(spark, known["Location"]) == qualified(spark, path):
        return
    if known["Type"] != "EXTERNAL":
        raise ValueError(f"{table} owns its files at {known['Location']}; {path} cannot take its place")
    spark.sql(f"DROP TABLE {table}")


def partitioned_tables(database: str = DATABASE) -> list[str]:
    silver = [f"{database}.silver_{d}" for d, partition in CLEAN_PARTITION.items() if partition]
    return silver + [f"{database}.gold_{m}" for m in MART_PARTITION]


def register(spark: SparkSession, paths: LakePaths, database: str = DATABASE) -> list[str]:
    """Declare the tables that have files, and load their partitions.

    A table of the same name with files elsewhere, of another lake, is declared anew.
    Partitions kept in the catalog let a query on one month plan without listing the rest.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    stored, partitioned = _stored(spark, paths, database), partitioned_tables(database)
    registered = [table for table in declarations(paths, database) if table in stored]
    for table in registered:
        _release(spark, table, places(paths, database)[table])
        spark.sql(declarations(paths, database)[table])
        if table in partitioned:
            refresh(spark, table)
    return registered


def refresh(spark: SparkSession, table: str) -> None:
    """Load partitions written since the table was declared, forget those that are gone."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def ask(spark: SparkSession, name: str, database: str = DATABASE, **parameters: str) -> DataFrame:
    """One of the analyst queries over its registered mart."""
    query = QUERIES[name]
    return query.on_table(spark, f"{database}.gold_{query.mart}", **parameters)
