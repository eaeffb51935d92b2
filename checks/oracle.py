"""ANSI SQL, run by DuckDB on the same tables, that gives each query's expected rows.

Money is added up as decimals and then rounded, unlike the bigints of the Spark side, and
rounded rates come from whole-number arithmetic, so the two sides share no method.
"""

from __future__ import annotations

from datetime import date, timedelta

START = date(1997, 1, 1)

_STATUS = """CASE l_returnflag WHEN 'N' THEN 'succeeded' WHEN 'R' THEN 'refunded' ELSE 'failed' END"""
_CURRENCY = """CASE l_suppkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' ELSE 'AUD' END"""
_METHOD = """CASE l_partkey % 5 WHEN 0 THEN 'card' WHEN 1 THEN 'paypal' WHEN 2 THEN 'apple_pay'
            WHEN 3 THEN 'google_pay' ELSE 'bank_transfer' END"""
_BOOKED = """CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'confirmed'
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'cancelled' ELSE 'no_show' END END"""
_REVIEW_DAY = "DATE '1997-01-01' + CAST((event_id * 353) % 730 AS INT)"
_TWICE = "CROSS JOIN (SELECT 1 AS copy UNION ALL SELECT 2) d WHERE copy = 1 OR"

VIEWS = {
    "listings": """SELECT c.c_custkey AS id, c.c_custkey AS listing_id, c.c_name AS name,
       CAST(c.c_nationkey AS BIGINT) AS host_id,
       n.n_name AS neighbourhood, c.c_mktsegment AS room_type, c.c_acctbal AS price,
       CAST(c.c_custkey % 7 + 1 AS INT) AS minimum_nights
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "bookings": f"""SELECT o_orderkey AS booking_id, o_custkey AS listing_id,
       o_orderkey % 900000 + 100000 AS guest_id,
       CAST(o_orderdate AS DATE) AS checkin_date,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 + 1 AS INT) AS checkout_date,
       CAST(o_orderkey % 14 + 1 AS INT) AS nights, o_totalprice AS amount, {_BOOKED} AS status,
       substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) AS checkin_month
FROM orders""",
    # payments as stored, without a listing; transactions add the booking's listing
    "payments": f"""SELECT l_orderkey * 10 + l_linenumber AS txn_id, l_orderkey AS booking_id,
       l_shipdate AS ts, CAST(l_shipdate AS DATE) AS txn_date,
       substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) AS txn_month,
       l_extendedprice AS amount, {_STATUS} AS status, {_CURRENCY} AS currency,
       {_METHOD} AS payment_method
FROM lineitem""",
    "transactions": f"""SELECT l_orderkey * 10 + l_linenumber AS txn_id, l_orderkey AS booking_id,
       o_custkey AS listing_id, l_shipdate AS ts, CAST(l_shipdate AS DATE) AS txn_date,
       substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7) AS txn_month,
       l_extendedprice AS amount, {_STATUS} AS status, {_CURRENCY} AS currency,
       {_METHOD} AS payment_method
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "reviews": f"""SELECT event_id AS id, user_id AS listing_id, {_REVIEW_DAY} AS review_date,
       event_id % 2000000 + 1000000 AS reviewer_id,
       'guest-' || CAST(event_id % 10000 AS STRING) AS reviewer_name,
       CAST(event_id % 5 + 1 AS INT) AS rating, event_type AS comments,
       substr(CAST({_REVIEW_DAY} AS STRING), 1, 7) AS review_month
FROM events""",
    "raw_reviews": f"""SELECT event_id AS id,
       CASE WHEN event_id % 61 = 1 THEN NULL ELSE user_id END AS listing_id,
       CASE WHEN event_id % 61 = 2 THEN 'not-a-date' ELSE CAST({_REVIEW_DAY} AS STRING) END AS date,
       CASE WHEN event_id % 61 = 3 THEN NULL ELSE event_id % 2000000 + 1000000 END AS reviewer_id,
       'guest-' || CAST(event_id % 10000 AS STRING) AS reviewer_name,
       CASE WHEN event_id % 61 = 4 THEN '0' ELSE CAST(event_id % 5 + 1 AS STRING) END AS rating,
       CASE WHEN event_id % 61 = 5 THEN '   ' ELSE event_type END AS comments
FROM events {_TWICE} event_id % 20 = 0""",
    "raw_bookings": f"""SELECT o_orderkey AS booking_id,
       CASE WHEN o_orderkey % 61 = 1 THEN NULL ELSE o_custkey END AS listing_id,
       CASE WHEN o_orderkey % 61 = 3 THEN NULL ELSE o_orderkey % 900000 + 100000 END AS guest_id,
       CASE WHEN o_orderkey % 61 = 2 THEN 'not-a-date'
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS checkin_date,
       CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 14 + 1 AS INT) AS STRING) AS checkout_date,
       CASE WHEN o_orderkey % 61 = 4 THEN '0' ELSE CAST(o_orderkey % 14 + 1 AS STRING) END AS nights,
       CASE WHEN o_orderkey % 61 = 5 THEN '-1.0' ELSE CAST(o_totalprice AS STRING) END AS amount,
       {_BOOKED} AS status
FROM orders {_TWICE} o_orderkey % 20 = 0""",
    "raw_transactions": f"""SELECT l_orderkey * 10 + l_linenumber AS txn_id,
       CASE WHEN l_orderkey % 61 = 1 THEN NULL ELSE l_orderkey END AS booking_id,
       CASE WHEN l_orderkey % 61 = 2 THEN 'not-a-timestamp' ELSE CAST(l_shipdate AS STRING) END AS ts,
       CASE WHEN l_orderkey % 61 = 3 THEN NULL ELSE CAST(l_extendedprice AS STRING) END AS amount,
       CASE WHEN l_orderkey % 61 = 4 THEN '  ' ELSE {_CURRENCY} END AS currency,
       CASE WHEN l_orderkey % 61 = 5 THEN '' ELSE {_METHOD} END AS payment_method,
       {_STATUS} AS status
FROM lineitem""",
    "raw_listings": f"""SELECT c_custkey AS id,
       CASE WHEN c_custkey % 61 = 1 THEN '  ' ELSE c_name END AS name,
       CAST(c_nationkey AS BIGINT) AS host_id, n_name AS neighbourhood, c_mktsegment AS room_type,
       CASE WHEN c_custkey % 61 = 2 THEN 'n/a' ELSE CAST(c_acctbal AS STRING) END AS price,
       CASE WHEN c_custkey % 61 = 3 THEN 'x' ELSE CAST(c_custkey % 7 + 1 AS STRING) END AS minimum_nights
FROM customer JOIN nation ON c_nationkey = n_nationkey {_TWICE} c_custkey % 20 = 0""",
}


def _whole(column: str) -> str:
    return f"CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS INT)"


def _first(source: str, key: str, order: str, ties: str) -> str:
    by = ", ".join(f"{c.strip()} NULLS FIRST" for c in f"{order}, {ties}".split(","))
    return (
        f"SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {by}) AS place FROM ({source})) WHERE place = 1"
    )


TYPED = {
    "listings": f"""SELECT id, name, host_id, neighbourhood, room_type,
       TRY_CAST(price AS DOUBLE) AS price, {_whole("minimum_nights")} AS minimum_nights
FROM raw_listings""",
    "reviews": f"""SELECT id, listing_id, reviewer_id, reviewer_name, {_whole("rating")} AS rating,
       comments, TRY_CAST(date AS DATE) AS review_date
FROM raw_reviews""",
    "bookings": f"""SELECT booking_id, listing_id, guest_id,
       TRY_CAST(checkin_date AS DATE) AS checkin_date, TRY_CAST(checkout_date AS DATE) AS checkout_date,
       {_whole("nights")} AS nights, TRY_CAST(amount AS DOUBLE) AS amount, status
FROM raw_bookings""",
    "transactions": """SELECT txn_id, booking_id, TRY_CAST(ts AS TIMESTAMP) AS ts,
       TRY_CAST(amount AS DOUBLE) AS amount, currency, payment_method, status
FROM raw_transactions""",
}

VIEWS |= {
    "typed_reviews": TYPED["reviews"],
    "clean_listings": _first(
        f"SELECT * FROM ({TYPED['listings']}) WHERE id IS NOT NULL AND trim(name) <> '' "
        "AND price > 0 AND NOT isnan(price) AND NOT isinf(price) AND minimum_nights IS NOT NULL",
        "id", "host_id", "name, neighbourhood, room_type, price, minimum_nights",
    ),
    "clean_reviews": _first(
        f"SELECT *, substr(CAST(review_date AS STRING), 1, 7) AS review_month FROM ({TYPED['reviews']}) "
        "WHERE id IS NOT NULL AND listing_id IS NOT NULL AND reviewer_id IS NOT NULL "
        "AND review_date IS NOT NULL AND trim(comments) <> '' AND rating >= 1 AND rating <= 5",
        "id", "review_date", "listing_id, reviewer_id, reviewer_name, rating, comments",
    ),
    "clean_bookings": _first(
        f"SELECT *, substr(CAST(checkin_date AS STRING), 1, 7) AS checkin_month FROM ({TYPED['bookings']}) "
        "WHERE booking_id IS NOT NULL AND listing_id IS NOT NULL AND guest_id IS NOT NULL "
        "AND checkin_date IS NOT NULL AND checkout_date IS NOT NULL AND checkout_date > checkin_date "
        "AND nights > 0 AND amount > 0 AND NOT isnan(amount) AND NOT isinf(amount) AND status IS NOT NULL",
        "booking_id", "checkin_date", "listing_id, guest_id, checkout_date, nights, amount, status",
    ),
    "clean_transactions": _first(
        f"SELECT *, CAST(ts AS DATE) AS txn_date FROM ({TYPED['transactions']}) "
        "WHERE txn_id IS NOT NULL AND booking_id IS NOT NULL AND ts IS NOT NULL AND amount > 0 "
        "AND NOT isnan(amount) AND NOT isinf(amount) AND trim(currency) <> '' "
        "AND trim(payment_method) <> '' AND status IS NOT NULL",
        "txn_id", "ts", "booking_id, amount, currency, payment_method, status",
    ),
}

# Which views a view reads, in the order they must be declared.
_NEEDS = {
    "typed_reviews": ["raw_reviews"],
    "clean_listings": ["raw_listings"],
    "clean_reviews": ["raw_reviews"],
    "clean_bookings": ["raw_bookings"],
    "clean_transactions": ["raw_transactions"],
}


def _over(views: str, body: str) -> str:
    """The query with the views it names (and theirs) as common table expressions."""
    names: list[str] = []
    for view in views.split():
        for name in (*_NEEDS.get(view, []), view):
            if name not in names:
                names.append(name)
    tables = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names)
    body = body.strip()
    # a body may go on with expressions of its own
    return f"WITH {tables}{',' if body.startswith('-- with') else ''}\n{body}"


def _days(column: str, offset: int, length: int) -> str:
    first = START + timedelta(days=offset)
    return f"{column} >= DATE '{first}' AND {column} < DATE '{first + timedelta(days=length)}'"


_CASH = "round(sum(CAST(amount AS DECIMAL(28,8))), 2)"
_DOLLARS = f"CAST({_CASH} AS DOUBLE)"
_PAID = "status = 'succeeded'"
_MONTHLY = f"-- with\nmonthly AS (SELECT txn_month, {_CASH} AS r FROM payments WHERE {_PAID} GROUP BY 1)\n"


def _half_up(part: str, whole: str, digits: int) -> str:
    """part / whole rounded half up, by whole numbers."""
    scale = 10**digits
    return (
        f"CAST((2 * {scale} * CAST({part} AS BIGINT) + {whole}) // (2 * {whole}) AS DOUBLE) / {scale}"
    )


QUERIES = {
    "q01_date_range_revenue": _over("payments", f"""
SELECT status, {_DOLLARS} AS total, count(*) AS n FROM payments
WHERE {_days("txn_date", 400, 30)} GROUP BY status"""),
    "q02_method_success": _over("payments", f"""
SELECT payment_method, {_DOLLARS} AS total, {_DOLLARS} / count(*) AS avg_amt FROM payments
WHERE {_PAID} GROUP BY payment_method"""),
    "q03_single_day": _over("payments", f"""
SELECT currency, {_DOLLARS} AS total FROM payments
WHERE txn_date = DATE '{START + timedelta(days=500)}' GROUP BY currency"""),
    "q04_txn_listing_join": _over("transactions listings", f"""
SELECT neighbourhood, {_DOLLARS} AS revenue FROM transactions t JOIN listings l USING (listing_id)
WHERE {_PAID} AND {_days("txn_date", 200, 30)} GROUP BY neighbourhood"""),
    "q05_txn_booking_join": _over("payments bookings", f"""
SELECT nights, CAST(round(sum(CAST(p.amount AS DECIMAL(28,8))), 2) AS DOUBLE) AS revenue, count(*) AS n
FROM payments p JOIN bookings b USING (booking_id)
WHERE p.{_PAID} AND {_days("txn_date", 250, 30)} AND b.status = 'completed' GROUP BY nights"""),
    "q06_three_way_join": _over("payments bookings listings", f"""
SELECT room_type, CAST(round(sum(CAST(p.amount AS DECIMAL(28,8))), 2) AS DOUBLE) AS revenue
FROM payments p JOIN bookings b USING (booking_id) JOIN listings l ON b.listing_id = l.listing_id
WHERE p.{_PAID} AND {_days("txn_date", 300, 90)} GROUP BY room_type"""),
    "q07_review_listing_join": _over("reviews listings", f"""
SELECT neighbourhood, avg(rating) AS avg_rating, count(*) AS n
FROM reviews r JOIN listings l ON r.listing_id = l.listing_id
WHERE {_days("review_date", 150, 30)} GROUP BY neighbourhood"""),
    "q08_bookings_by_month": _over("bookings", f"""
SELECT checkin_month, status, {_DOLLARS} AS gmv, count(*) AS n FROM bookings
WHERE {_days("checkin_date", 120, 90)} GROUP BY checkin_month, status"""),
    "q09_running_total": _over("payments", f"""{_MONTHLY}
SELECT txn_month, CAST(r AS DOUBLE) AS revenue, CAST(sum(r) OVER (ORDER BY txn_month
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM monthly"""),
    "q10_topn_per_month": _over("transactions", f"""
SELECT txn_month, listing_id, revenue, rk FROM (
  SELECT txn_month, listing_id, {_DOLLARS} AS revenue, CAST(dense_rank() OVER (
    PARTITION BY txn_month ORDER BY {_CASH} DESC) AS INT) AS rk
  FROM transactions WHERE {_PAID} GROUP BY txn_month, listing_id) WHERE rk <= 3"""),
    "q11_moving_avg_3m": _over("payments", f"""{_MONTHLY}
SELECT txn_month, CAST(r AS DOUBLE) AS revenue,
  CAST(sum(r) OVER recent AS DOUBLE) / count(*) OVER recent AS moving_avg_3m
FROM monthly WINDOW recent AS (ORDER BY txn_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    "q12_nbhd_share": _over("transactions listings", f"""-- with
g AS (SELECT neighbourhood, listing_id, {_CASH} AS r FROM transactions t JOIN listings l
  USING (listing_id) WHERE {_PAID} GROUP BY neighbourhood, listing_id)
SELECT neighbourhood, listing_id, CAST(r AS DOUBLE) AS revenue,
  CAST(sum(r) OVER area AS DOUBLE) AS nbhd_total,
  CAST(r AS DOUBLE) / CAST(sum(r) OVER area AS DOUBLE) AS share
FROM g WINDOW area AS (PARTITION BY neighbourhood)"""),
    "q13_rank_nbhd": _over("transactions listings", f"""
SELECT neighbourhood, {_DOLLARS} AS revenue, CAST(rank() OVER (ORDER BY {_CASH} DESC) AS INT) AS rank
FROM transactions t JOIN listings l USING (listing_id)
WHERE {_PAID} AND {_days("txn_date", 400, 90)} GROUP BY neighbourhood"""),
    "q14_mom_delta": _over("payments", f"""{_MONTHLY}
SELECT txn_month, CAST(r AS DOUBLE) AS revenue, CAST(lag(r) OVER m AS DOUBLE) AS prev,
  CAST(r - lag(r) OVER m AS DOUBLE) AS mom_delta FROM monthly WINDOW m AS (ORDER BY txn_month)"""),
    "q15_pareto_share": _over("transactions", f"""-- with
g AS (SELECT listing_id, {_CASH} AS r FROM transactions WHERE {_PAID} GROUP BY listing_id),
c AS (SELECT listing_id, CAST(r AS DOUBLE) AS revenue,
  CAST(sum(r) OVER (ORDER BY r DESC, listing_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS DOUBLE) AS cum_rev, CAST(sum(r) OVER () AS DOUBLE) AS grand_total FROM g)
SELECT *, cum_rev / grand_total AS cum_share FROM c"""),
    "q16_success_rate": _over("payments", f"""
SELECT payment_method, CAST(sum(CASE WHEN {_PAID} THEN 1 ELSE 0 END) AS DOUBLE) / count(*)
  AS success_rate, count(*) AS attempts
FROM payments WHERE {_days("txn_date", 200, 90)} GROUP BY payment_method"""),
    "q17_conversion": _over("payments bookings", f"""-- with
b AS (SELECT booking_id, listing_id FROM bookings WHERE {_days("checkin_date", 350, 30)}),
paid AS (SELECT listing_id, count(*) AS paid FROM b JOIN payments p USING (booking_id)
  WHERE {_PAID} GROUP BY listing_id),
total AS (SELECT listing_id, count(*) AS bookings FROM b GROUP BY listing_id)
SELECT listing_id, bookings, paid, CAST(paid AS DOUBLE) / bookings AS conversion
FROM total LEFT JOIN paid USING (listing_id)"""),
    "q18_reviews_vs_revenue": _over("transactions reviews", f"""-- with
rated AS (SELECT listing_id, avg(rating) AS avg_rating, count(*) AS n_reviews FROM reviews
  WHERE {_days("review_date", 180, 90)} GROUP BY listing_id),
money AS (SELECT listing_id, {_DOLLARS} AS revenue FROM transactions
  WHERE {_PAID} AND {_days("txn_date", 180, 90)} GROUP BY listing_id)
SELECT listing_id, avg_rating, n_reviews, revenue FROM rated JOIN money USING (listing_id)"""),
    "q19_wide_scan": _over("payments", f"""
SELECT status, {_DOLLARS} AS total, count(*) AS n FROM payments GROUP BY status"""),
    "q20_avg_daily_rev": _over("transactions listings", f"""-- with
daily AS (SELECT neighbourhood, txn_date, {_CASH} AS r FROM transactions t
  JOIN listings l USING (listing_id) WHERE {_PAID} AND {_days("txn_date", 450, 30)} GROUP BY 1, 2)
SELECT neighbourhood, CAST(sum(r) AS DOUBLE) / count(*) AS avg_daily_rev FROM daily GROUP BY 1"""),
    "q21_gold_preagg": _over("transactions listings", f"""
SELECT neighbourhood, {_DOLLARS} AS revenue, count(*) AS txns
FROM transactions t JOIN listings l USING (listing_id) WHERE {_PAID} GROUP BY neighbourhood"""),
    "q22_moving_avg_7d": _over("payments", f"""-- with
daily AS (SELECT txn_date, {_CASH} AS r FROM payments
  WHERE {_PAID} AND {_days("txn_date", 260, 90)} GROUP BY 1)
SELECT txn_date, CAST(r AS DOUBLE) AS day_rev,
  CAST(sum(r) OVER recent AS DOUBLE) / count(*) OVER recent AS moving_avg_7d
FROM daily WINDOW recent AS (ORDER BY txn_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""),
}

_MARTS = {
    "reviews_per_listing": ("clean_listings clean_reviews", """
SELECT l.id, l.name, l.neighbourhood, count(r.id) AS num_reviews
FROM clean_listings l JOIN clean_reviews r ON l.id = r.listing_id GROUP BY 1, 2, 3"""),
    "avg_rating_per_listing": ("clean_listings clean_reviews", f"""
SELECT l.id, l.name, {_half_up("sum(rating)", "count(rating)", 2)} AS avg_rating,
  count(r.id) AS num_reviews
FROM clean_listings l JOIN clean_reviews r ON l.id = r.listing_id GROUP BY 1, 2"""),
    "reviews_per_neighbourhood": ("clean_listings clean_reviews", f"""
SELECT l.neighbourhood, count(r.id) AS num_reviews,
  {_half_up("sum(rating)", "count(rating)", 2)} AS avg_rating, count(DISTINCT l.id) AS num_listings
FROM clean_listings l JOIN clean_reviews r ON l.id = r.listing_id GROUP BY 1"""),
    "revenue_by_listing_month": ("clean_listings clean_bookings", f"""
SELECT l.id, l.name, l.neighbourhood, b.checkin_month, count(b.booking_id) AS num_bookings,
  CAST(sum(b.nights) AS BIGINT) AS total_nights, {_DOLLARS} AS total_revenue
FROM clean_listings l JOIN clean_bookings b ON l.id = b.listing_id
WHERE b.status = 'completed' GROUP BY 1, 2, 3, 4"""),
    "booking_conversion": ("clean_listings clean_bookings", f"""-- with
g AS (SELECT l.id, l.name, count(b.booking_id) AS total_bookings,
  count(*) FILTER (status = 'completed') AS completed,
  count(*) FILTER (status = 'confirmed') AS confirmed,
  count(*) FILTER (status IN ('cancelled', 'no_show')) AS cancelled
FROM clean_listings l JOIN clean_bookings b ON l.id = b.listing_id GROUP BY 1, 2)
SELECT *, {_half_up("(completed + confirmed)", "total_bookings", 4)} AS conversion_rate,
  {_half_up("cancelled", "total_bookings", 4)} AS cancellation_rate FROM g"""),
    "transaction_success_rates": ("clean_transactions", f"""-- with
g AS (SELECT payment_method, count(txn_id) AS total_txns,
  count(*) FILTER (status = 'succeeded') AS succeeded, count(*) FILTER (status = 'failed') AS failed,
  count(*) FILTER (status = 'refunded') AS refunded,
  CAST(round(sum(CASE WHEN {_PAID} THEN CAST(amount AS DECIMAL(28,8)) ELSE 0 END), 2) AS DOUBLE) AS settled_amount
FROM clean_transactions GROUP BY 1)
SELECT *, {_half_up("succeeded", "total_txns", 4)} AS success_rate FROM g"""),
}

_ANALYST = {
    "sql_top_reviewed": ("reviews_per_listing", """name, neighbourhood, num_reviews FROM mart
ORDER BY num_reviews DESC, id LIMIT 10"""),
    "sql_top_rated_min5": ("avg_rating_per_listing", """name, avg_rating, num_reviews FROM mart
WHERE num_reviews >= 5 ORDER BY avg_rating DESC, id LIMIT 10"""),
    "sql_neighbourhood_volume": ("reviews_per_neighbourhood",
        "neighbourhood, num_listings, num_reviews, avg_rating FROM mart"),
    "sql_month_top_earners": ("revenue_by_listing_month",
        """name, neighbourhood, num_bookings, total_revenue FROM mart
WHERE checkin_month = '1998-06' ORDER BY total_revenue DESC, id LIMIT 10"""),
    "sql_weakest_conversion": ("booking_conversion",
        """name, total_bookings, conversion_rate, cancellation_rate FROM mart
WHERE total_bookings >= 5 ORDER BY conversion_rate, id LIMIT 10"""),
    "sql_payment_reliability": ("transaction_success_rates",
        "payment_method, total_txns, success_rate, settled_amount FROM mart"),
}

for _name, (_views, _body) in _MARTS.items():
    QUERIES[_name] = _over(_views, _body)
for _name, (_mart, _tail) in _ANALYST.items():
    QUERIES[_name] = f"SELECT {_tail.replace('FROM mart', f'FROM ({QUERIES[_mart]}) AS mart')}"

QUERIES |= {
    "summary_listing_month": _over("transactions listings", f"""
SELECT listing_id, txn_month, {_DOLLARS} AS revenue, count(*) AS txn_count,
  {_DOLLARS} / count(*) AS avg_ticket, neighbourhood, room_type
FROM transactions t JOIN listings l USING (listing_id) WHERE {_PAID} GROUP BY 1, 2, 6, 7"""),
    "dim_listing": _over("listings", """
SELECT listing_id, neighbourhood, room_type, price, minimum_nights FROM listings"""),
    "fact_transactions": _over("transactions", """
SELECT txn_id, booking_id, listing_id, txn_date, txn_month, amount, status, currency, payment_method
FROM transactions"""),
    "fact_bookings": _over("bookings", """
SELECT booking_id, listing_id, guest_id, checkin_date, checkin_month, nights, amount, status
FROM bookings"""),
    "fact_reviews": _over("reviews", """
SELECT id AS review_id, listing_id, reviewer_id, review_date, review_month, rating FROM reviews"""),
    **{f"clean_{d}": _over(f"clean_{d}", f"SELECT * FROM clean_{d}") for d in TYPED},
    "dedupe_earliest": _over("payments", _first(
        "SELECT * FROM payments", "txn_id", "ts",
        "booking_id, txn_date, txn_month, amount, status, currency, payment_method")),
    "dq_reviews": _over("typed_reviews clean_reviews", " UNION ALL ".join(
        f"""SELECT '{stage}' AS stage, count(*) AS row_count, count(DISTINCT id) AS distinct_ids,
  count(id) - count(DISTINCT id) AS duplicate_ids,
  count(*) FILTER (id IS NULL OR listing_id IS NULL) AS null_keys,
  count(*) FILTER (rating < 1 OR rating > 5) AS out_of_range_ratings,
  count(*) FILTER (rating IS NULL) AS null_ratings FROM {stage}_reviews"""
        for stage in ("typed", "clean"))),
    "landed_counts": _over("raw_listings raw_reviews raw_bookings raw_transactions",
        " UNION ALL ".join(
            f"SELECT '{d}' AS dataset, DATE '2024-11-30' AS ingest_date, count(*) AS records FROM raw_{d}"
            for d in TYPED)),
    "tuned_month_read": _over("transactions", f"""
SELECT txn_month, status, {_DOLLARS} AS total, count(*) AS n FROM transactions
WHERE {_days("txn_date", 120, 30)} GROUP BY 1, 2"""),
    "synth_status_months": """
WITH ids AS (SELECT l_orderkey * 10 + l_linenumber AS txn_id FROM lineitem),
drawn AS (SELECT CASE txn_id % 3 WHEN 0 THEN 'succeeded' WHEN 1 THEN 'failed' ELSE 'refunded' END AS status,
  DATE '2023-01-01' + CAST((txn_id * 2654435761) % 730 AS INT) AS txn_date FROM ids)
SELECT status, substr(CAST(txn_date AS STRING), 1, 7) AS txn_month, count(*) AS n
FROM drawn GROUP BY 1, 2""",
    "subcent_totals": """
WITH lines AS (SELECT l_returnflag, l_linestatus,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 4) AS DECIMAL(28,8)) / 100 - 20
    AS amount FROM lineitem)
SELECT l_returnflag, l_linestatus,
  CAST(round(sum(CAST(amount AS DECIMAL(28,8))), 2) AS DOUBLE) AS total,
  CAST(round(sum(CAST(amount / 1000 AS DECIMAL(28,8))), 2) AS DOUBLE) AS thousandth,
  count(*) AS n
FROM lines GROUP BY 1, 2""",
}

# The same answers from other ways of storing and reading the tables.
for _key in ("q05_txn_booking_join", "q06_three_way_join", "q17_conversion"):
    QUERIES[f"{_key}_bucketed"] = QUERIES[_key]
for _key in (
    "q09_running_total", "q10_topn_per_month", "q11_moving_avg_3m", "q12_nbhd_share", "q14_mom_delta",
    "q15_pareto_share", "q21_gold_preagg",
):
    QUERIES[f"{_key}_summary"] = QUERIES[_key]
for _name in TYPED:
    QUERIES[f"clean_{_name}_landed"] = QUERIES[f"clean_{_name}"]
for _name in _ANALYST:
    QUERIES[f"{_name}_registered"] = QUERIES[_name]


def _half_the_bookings(sql: str) -> str:
    return sql.replace("FROM orders CROSS", "FROM (SELECT * FROM orders WHERE o_orderkey % 2 = 0) orders CROSS")


def _spread(key: str, step: int) -> str:
    """Month of a generated row."""
    return f"substr(CAST(DATE '2023-01-01' + CAST({key} % 730 * ({step} % 730) % 730 AS INT) AS STRING), 1, 7)"


QUERIES |= {
    "pipeline_relanded": " UNION ALL ".join(
        [
            f"SELECT '{kind} {name}' AS what, count(*) AS n FROM ({_half_the_bookings(QUERIES[query])})"
            for kind, names in (("clean", TYPED), ("mart", _MARTS))
            for name in names
            for query in [f"clean_{name}" if kind == "clean" else name]
            if name not in ("transactions", "transaction_success_rates")
        ]
        + [
            "SELECT 'nights' AS what, CAST(sum(total_nights) AS BIGINT) AS n "
            f"FROM ({_half_the_bookings(QUERIES['revenue_by_listing_month'])})"
        ]
    ),
    "synth_facts": f"""
SELECT 'bookings' AS what,
  CASE o_orderkey % 4 WHEN 0 THEN 'completed' WHEN 1 THEN 'confirmed' WHEN 2 THEN 'cancelled' ELSE 'no_show' END AS part,
  {_spread("o_orderkey", 40503)} AS month, count(*) AS n, CAST(sum(o_orderkey % 14 + 1) AS BIGINT) AS total
FROM orders GROUP BY 1, 2, 3
UNION ALL SELECT 'reviews', CAST(event_id % 5 + 1 AS STRING), {_spread("event_id", 97007)}, count(*),
  CAST(sum(event_id % 700) AS BIGINT) FROM events GROUP BY 1, 2, 3
UNION ALL SELECT 'listings',
  CASE c_custkey % 4 WHEN 0 THEN 'Entire home/apt' WHEN 1 THEN 'Private room' WHEN 2 THEN 'Shared room' ELSE 'Hotel room' END,
  CASE c_custkey % 8 WHEN 0 THEN 'Downtown' WHEN 1 THEN 'Mission District' WHEN 2 THEN 'Capitol Hill'
    WHEN 3 THEN 'Williamsburg' WHEN 4 THEN 'Shoreditch' WHEN 5 THEN 'Le Marais' WHEN 6 THEN 'Kreuzberg' ELSE 'Fitzroy' END,
  count(*), CAST(sum(c_custkey % 7 + 1) AS BIGINT) FROM customer GROUP BY 1, 2, 3""",
    "synth_raw_defects": """
SELECT * FROM (VALUES ('listings', 0, true), ('reviews', 0, true), ('bookings', 0, true), ('transactions', 0, true),
  ('reviews without parent', 0, true), ('transactions without parent', 0, true)) AS t(dataset, repeated, filled)""",
}
