"""Declare the tables of a lake in the session's catalog and answer the analyst queries.

    python -m roost.jobs.register_tables --root PATH [--month yyyy-MM] [--print-ddl]
"""

from __future__ import annotations

import argparse
import sys

from roost.paths import LakePaths
from roost.plans import catalog
from roost.plans.analyst_sql import QUERIES
from roost.session import build_session


def main(argv: list[str]) -> None:
    options = argparse.ArgumentParser(description=__doc__)
    options.add_argument("--root", required=True, help="base path of the layers")
    options.add_argument("--database", default=catalog.DATABASE)
    options.add_argument("--month", default="2024-06", help="month of the top earners")
    options.add_argument("--print-ddl", action="store_true", help="only print the statements")
    chosen = options.parse_args(argv)
    paths = LakePaths.under(chosen.root)
    if chosen.print_ddl:
        print(";\n".join(catalog.declarations(paths, chosen.database).values()) + ";")
        return
    spark = build_session("roost-register-tables")
    try:
        tables = catalog.register(spark, paths, chosen.database)
        for name, query in QUERIES.items():
            if f"{chosen.database}.gold_{query.mart}" in tables:
                month = {"month": chosen.month} if ":month" in query.sql else {}
                print(name)
                catalog.ask(spark, name, chosen.database, **month).show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
