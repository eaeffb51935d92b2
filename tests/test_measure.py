"""Timing and reporting."""

from pyspark.sql import functions as F

from roost.measure import report
from roost.measure.timing import count_rows, median_seconds, run_to_end
from roost.plans.workloads import WORKLOADS
from roost.sources.synthetic import Scale


def test_reduction_and_speedup():
    assert report.reduction(4.0, 1.0) == 75.0 and report.speedup(4.0, 1.0) == 4.0
    assert report.reduction(0.0, 1.0) == 0.0 and report.speedup(1.0, 0.0) is None


def test_timed_runs_compute_every_column(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def touch(value):
        seen.add(1)
        return 1

    df = spark.range(10).withColumn("unused", touch("id"))
    count_rows(df)
    assert seen.value == 0
    run_to_end(df)
    assert seen.value == 10


def test_median_leaves_warm_ups_out(spark):
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    assert median_seconds(build, runs=3, warm_ups=2) > 0
    assert len(built) == 5


def test_report():
    plain = {key: 2.0 for key in WORKLOADS}
    tuned = {key: 0.5 for key in WORKLOADS}
    scale = Scale(60, 12, 12, 5)
    result = report.compare(plain, tuned, {"plain": 4_000_000_000, "tuned": 1_000_000_000}, scale, 3)
    assert (result["plain_seconds"], result["tuned_seconds"]) == (44.0, 11.0)
    assert (result["reduction_pct"], result["speedup_x"], result["query_count"]) == (75.0, 4.0, 22)
    text = report.as_markdown(result)
    assert "4.00 GB and 1.00 GB" in text and text.count("| q") == 23
