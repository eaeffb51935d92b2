"""A copy of the mapped tables in which single keys hold a third of the rows."""

from pathlib import Path

import duckdb

# A third of the payments on one booking, of the bookings on one listing, of the reviews
# on one listing; copies of one review, one booking and one listing; one large
# neighbourhood. The copied keys differ from the hot ones, so joins stay small.
SKEW = {
    "lineitem": """SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN
        (SELECT max(o_orderkey) FROM orders) ELSE l_orderkey END AS l_orderkey) FROM lineitem""",
    "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)
        FROM orders UNION ALL
        SELECT o.* FROM orders o, range((SELECT count(*) // 2 FROM orders)) WHERE o_orderkey = 11""",
    "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 9 ELSE user_id END AS user_id)
        FROM events UNION ALL
        SELECT e.* REPLACE (CAST(n % 4 AS VARCHAR) || event_type AS event_type)
        FROM events e, range((SELECT count(*) // 2 FROM events)) r(n) WHERE event_id = 62""",
    "customer": """SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 4 ELSE c_nationkey END
        AS c_nationkey) FROM customer UNION ALL
        SELECT c.* FROM customer c, range(20) WHERE c_custkey = 13""",
    "nation": "SELECT * FROM nation",
}


def write_skewed(source: str, target: Path) -> str:
    sql = duckdb.connect()
    for table in SKEW:
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{source}/{table}.parquet')")
    for table, query in SKEW.items():
        sql.execute(f"COPY ({query}) TO '{target}/{table}.parquet' (FORMAT parquet)")
    return str(target)
