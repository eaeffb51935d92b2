"""Every query by name, over the mapped tables of a directory."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roost.functions.money import dollars, total_cents
from roost.operators.cleaning import DOMAINS
from roost.operators.dedupe import first_per_key
from roost.operators.pruning import in_days
from roost.operators.quality import GATES
from roost.paths import DATASETS, LakePaths
from roost.plans import analyst_sql, catalog, layouts, marts, medallion, star
from roost.plans.workloads import WORKLOADS
from roost.schemas import MARTS
from roost.session import fresh_scratch
from roost.sinks.layout import TUNED, rows_per_key, write_tuned
from roost.sinks.tables import land, write_mart
from roost.sources import mapped, synthetic
from roost.sources.raw import count_landed, read_raw
from roost.sources.stored import read_clean, read_mart
from roost.sources.synthetic_raw import RawData

BUCKETS = 4  # at least; more by the rows

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def _register(name: str):
    def keep(query: Query) -> Query:
        REGISTRY[name] = query
        return query

    return keep


def _workload(plan) -> Query:
    return lambda spark, sf_dir: plan(mapped.marketplace(spark, sf_dir))


for _key, _entry in WORKLOADS.items():
    REGISTRY[_key] = _workload(_entry.plan)

for _table in (
    star.summary_listing_month,
    star.dim_listing,
    star.fact_transactions,
    star.fact_bookings,
    star.fact_reviews,
):
    REGISTRY[_table.__name__] = _workload(_table)


def _clean(dataset: str) -> Query:
    return lambda spark, sf_dir: DOMAINS[dataset].clean(mapped.RAW[dataset](spark, sf_dir))


def _clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wall-clock times without a zone, like those of the source table."""
    rows = _clean("transactions")(spark, sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


for _dataset in DATASETS:
    REGISTRY[f"clean_{_dataset}"] = _clean(_dataset)
REGISTRY["clean_transactions"] = _clean_transactions


_MART_INPUTS = {
    marts.reviews_per_listing: ("listings", "reviews"),
    marts.avg_rating_per_listing: ("listings", "reviews"),
    marts.reviews_per_neighbourhood: ("listings", "reviews"),
    marts.revenue_by_listing_month: ("listings", "bookings"),
    marts.booking_conversion: ("listings", "bookings"),
    marts.transaction_success_rates: ("transactions",),
}


def _mart(build, inputs: tuple[str, ...]) -> Query:
    return lambda spark, sf_dir: build(*[_clean(dataset)(spark, sf_dir) for dataset in inputs])


for _build, _inputs in _MART_INPUTS.items():
    REGISTRY[_build.__name__] = _mart(_build, _inputs)


def _analyst(query: analyst_sql.AnalystQuery, **parameters: str) -> Query:
    return lambda spark, sf_dir: query.run(REGISTRY[query.mart](spark, sf_dir), **parameters)


for _name, _query in analyst_sql.QUERIES.items():
    REGISTRY[_name] = _analyst(_query, **({"month": "1998-06"} if ":month" in _query.sql else {}))


@_register("dedupe_earliest")
def _dedupe_earliest(spark, sf_dir):
    """Payment ids repeat with different contents in the source."""
    return first_per_key(mapped.payments(spark, sf_dir), "txn_id", "ts")


@_register("dq_reviews")
def _dq_reviews(spark, sf_dir):
    """The gate's counts before and after cleaning."""
    raw = mapped.raw_reviews(spark, sf_dir)
    stages = {"typed": DOMAINS["reviews"].typed(raw), "clean": DOMAINS["reviews"].clean(raw)}
    measured = [
        GATES["reviews"].measure(rows).select(F.lit(stage).alias("stage"), "*")
        for stage, rows in stages.items()
    ]
    return measured[0].union(measured[1])


@_register("landed_counts")
def _landed_counts(spark, sf_dir):
    """Land the raw records, the reviews twice, and count what lies under the date."""
    paths = LakePaths.under(fresh_scratch(spark, "landing"))
    for dataset in (*DATASETS, "reviews"):
        land(mapped.RAW[dataset](spark, sf_dir), paths, dataset, "2024-11-30")
    return reduce(DataFrame.union, [count_landed(spark, paths, dataset) for dataset in DATASETS])


@_register("tuned_month_read")
def _tuned_month_read(spark, sf_dir):
    """Write the tuned payments, then read 30 days through their month directories."""
    lake = mapped.marketplace(spark, sf_dir)
    path = fresh_scratch(spark, "tuned")
    counts = rows_per_key(lake.payments, TUNED["transactions"])
    write_tuned(star.fact_transactions(lake), path, TUNED["transactions"], counts)
    tuned = in_days(spark.read.parquet(path), "txn_date", lake.span(120, 30), "txn_month")
    return tuned.groupBy("txn_month", "status").agg(
        dollars(total_cents()).alias("total"), F.count(F.lit(1)).alias("n")
    )


def _over_buckets(plan) -> Query:
    """A workload over payments and bookings written in buckets of ``booking_id``."""

    def query(spark, sf_dir):
        lake = mapped.marketplace(spark, sf_dir)
        base = fresh_scratch(spark, "buckets")
        database = base.rsplit("/", 1)[1].replace("-", "_")
        if layouts.write_bucketed_layout(spark, base, database, lake, BUCKETS):
            lake = layouts.with_buckets(spark, lake, database)
        return plan(lake)

    return query


for _key in ("q05_txn_booking_join", "q06_three_way_join", "q17_conversion"):
    REGISTRY[f"{_key}_bucketed"] = _over_buckets(WORKLOADS[_key].plan)


# Workloads that read the summary where a layout has one.
SUMMED = (
    "q09_running_total",
    "q10_topn_per_month",
    "q11_moving_avg_3m",
    "q12_nbhd_share",
    "q14_mom_delta",
    "q15_pareto_share",
    "q21_gold_preagg",
)


def _over_summary(plan) -> Query:
    """A workload over the stored summary, read back as a layout's."""

    def query(spark, sf_dir):
        lake = mapped.marketplace(spark, sf_dir)
        path = fresh_scratch(spark, "summary")
        counts = rows_per_key(lake.payments, TUNED["summary"])
        write_tuned(star.summary_listing_month(lake), path, TUNED["summary"], counts)
        return plan(replace(lake, summary=spark.read.parquet(path)))

    return query


for _key in SUMMED:
    REGISTRY[f"{_key}_summary"] = _over_summary(WORKLOADS[_key].plan)


def _clean_landed(dataset: str) -> Query:
    """Clean records that were landed as JSON and read back as text."""

    def query(spark, sf_dir):
        paths = LakePaths.under(fresh_scratch(spark, "landed"))
        land(mapped.RAW[dataset](spark, sf_dir), paths, dataset, "2024-11-30")
        rows = DOMAINS[dataset].clean(read_raw(spark, paths, dataset))
        return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz")) if "ts" in rows.columns else rows

    return query


for _dataset in DATASETS:
    REGISTRY[f"clean_{_dataset}_landed"] = _clean_landed(_dataset)


def _registered(name: str, query: analyst_sql.AnalystQuery, **parameters: str) -> Query:
    """An analyst query by table name, over its mart as written and registered."""

    def ask(spark, sf_dir):
        base = fresh_scratch(spark, "lake")
        paths, database = LakePaths.under(base), base.rsplit("/", 1)[1].replace("-", "_")
        write_mart(REGISTRY[query.mart](spark, sf_dir), paths, query.mart)
        catalog.register(spark, paths, database)
        return catalog.ask(spark, name, database, **parameters)

    return ask


for _name, _query in analyst_sql.QUERIES.items():
    REGISTRY[f"{_name}_registered"] = _registered(
        _name, _query, **({"month": "1998-06"} if ":month" in _query.sql else {})
    )


@_register("pipeline_relanded")
def _pipeline_relanded(spark, sf_dir):
    """The pipeline twice, the second time without half of the bookings: what the files hold
    then, as row counts of clean tables and marts, and one total. Payments stay out of it:
    their clean table has a folder for each of some 2500 days."""
    paths = LakePaths.under(fresh_scratch(spark, "relanded"))
    datasets = [d for d in DATASETS if d != "transactions"]
    raw = {dataset: mapped.RAW[dataset](spark, sf_dir) for dataset in datasets}
    medallion.run(spark, paths, raw, "2024-11-30", gated=())
    raw["bookings"] = raw["bookings"].where("booking_id % 2 = 0")
    medallion.run(spark, paths, raw, "2024-11-30", gated=())
    counted = F.count(F.lit(1)).alias("n")
    parts = [read_clean(spark, paths, d).agg(F.lit(f"clean {d}").alias("what"), counted) for d in datasets]
    parts += [read_mart(spark, paths, m).agg(F.lit(f"mart {m}").alias("what"), counted) for m in MARTS if m != "transaction_success_rates"]
    nights = read_mart(spark, paths, "revenue_by_listing_month").agg(
        F.lit("nights").alias("what"), F.sum("total_nights").alias("n")
    )
    return reduce(DataFrame.union, [*parts, nights])


@_register("synth_facts")
def _synth_facts(spark, sf_dir):
    """Generated bookings, reviews and listings, one for each row of the source's tables."""
    listings = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("id"))
    bookings = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id"))
    reviews = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"))
    shape = lambda what, *rest: [F.lit(what).alias("what"), *rest]
    n, total = F.count(F.lit(1)).alias("n"), lambda c: F.sum(F.col(c).cast("bigint")).alias("total")
    booked = synthetic.bookings(bookings, 700).groupBy(F.col("status").alias("part"), F.col("checkin_month").alias("month"))
    rated = synthetic.reviews(reviews, 700).groupBy(F.col("rating").cast("string").alias("part"), F.col("review_month").alias("month"))
    listed = synthetic.listings(listings).groupBy(F.col("room_type").alias("part"), F.col("neighbourhood").alias("month"))
    return (
        booked.agg(n, total("nights")).select(*shape("bookings"), "*")
        .union(rated.agg(n, total("listing_id")).select(*shape("reviews"), "*"))
        .union(listed.agg(n, total("minimum_nights")).select(*shape("listings"), "*"))
    )


@_register("synth_raw_defects")
def _synth_raw_defects(spark, sf_dir):
    """Raw records generated for as many listings as the source has customers: defects and
    repeats must all be gone after cleaning, and every child must have its parent."""
    count = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    raw = RawData(listings=count, dirty_ratio=0.2, duplicate_ratio=0.1).tables(spark)
    clean = {d: DOMAINS[d].clean(rows) for d, rows in raw.items()}
    key = {d: DOMAINS[d].key for d in DATASETS}
    orphans = {
        "reviews": clean["reviews"].join(clean["listings"].select(F.col("id").alias("listing_id")), "listing_id", "left_anti"),
        "transactions": clean["transactions"].join(raw["bookings"].select("booking_id"), "booking_id", "left_anti"),
    }
    return reduce(
        DataFrame.union,
        [
            clean[d].agg(
                F.lit(d).alias("dataset"),
                (F.count(F.lit(1)) - F.count_distinct(key[d])).alias("repeated"),
                (F.count(F.lit(1)) > 0).alias("filled"),
            )
            for d in DATASETS
        ]
        + [
            rows.agg(F.lit(f"{d} without parent").alias("dataset"), F.count(F.lit(1)).alias("repeated"), F.lit(True).alias("filled"))
            for d, rows in orphans.items()
        ],
    )


@_register("synth_status_months")
def _synth_status_months(spark, sf_dir):
    """Generated payments, one per payment of the source, counted by status and month."""
    ids = mapped.payments(spark, sf_dir).select(F.col("txn_id").alias("id"))
    drawn = synthetic.transactions(ids, synthetic.LARGE_LISTINGS, synthetic.LARGE_LISTINGS)
    return drawn.groupBy("status", "txn_month").agg(F.count(F.lit(1)).alias("n"))


@_register("subcent_totals")
def _subcent_totals(spark, sf_dir):
    """Amounts with parts of a cent, negative ones too, are rounded after they are added."""
    discounted = F.col("l_extendedprice") * F.col("l_discount") / 100 - F.lit(20)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_returnflag", "l_linestatus", discounted.alias("amount")
    )
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        dollars(total_cents()).alias("total"),
        dollars(total_cents(F.col("amount") / 1000)).alias("thousandth"),
        F.count(F.lit(1)).alias("n"),
    )
