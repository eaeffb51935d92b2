"""Comparison of two layouts, as data and as text."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession

from roost.plans.workloads import WORKLOADS
from roost.sources.synthetic import Scale


def reduction(before: float, after: float) -> float:
    """Time saved, in percent."""
    return round(100 * (1 - after / before), 2) if before > 0 else 0.0


def speedup(before: float, after: float) -> float | None:
    return round(before / after, 2) if after > 0 else None


_DONE = {"noop": "every output column computed", "count": "rows counted only"}


def compare(
    plain: Mapping[str, float],
    tuned: Mapping[str, float],
    sizes: Mapping[str, int],
    scale: Scale,
    runs: int,
    action: str = "noop",
) -> dict:
    """Per-query and total times of both layouts, with their sizes."""
    before, after = sum(plain.values()), sum(tuned.values())
    return {
        "runs_per_query": runs,
        "action": action,
        "query_count": len(plain),
        "rows": vars(scale),
        "plain_seconds": round(before, 4),
        "tuned_seconds": round(after, 4),
        "reduction_pct": reduction(before, after),
        "speedup_x": speedup(before, after),
        "bytes": dict(sizes),
        "per_query": [
            {
                "query": key,
                "title": WORKLOADS[key].title,
                "technique": WORKLOADS[key].technique,
                "plain_seconds": plain[key],
                "tuned_seconds": tuned[key],
                "reduction_pct": reduction(plain[key], tuned[key]),
                "speedup_x": speedup(plain[key], tuned[key]),
            }
            for key in plain
        ],
    }


def as_markdown(result: Mapping) -> str:
    rows = result["rows"]
    sizes = result["bytes"]
    head = [
        "# Layout comparison",
        "",
        f"{rows['transactions']:,} payments, {rows['bookings']:,} bookings, {rows['reviews']:,} "
        f"reviews, {rows['listings']:,} listings. Median of {result['runs_per_query']} runs after "
        f"a warm-up, {_DONE[result['action']]}.",
        "",
        f"Total {result['plain_seconds']} s on the plain layout, {result['tuned_seconds']} s on "
        f"the tuned one: {result['reduction_pct']} % less, {result['speedup_x']}x. On disk "
        f"{sizes['plain'] / 1e9:.2f} GB and {sizes['tuned'] / 1e9:.2f} GB.",
        "",
        "| query | technique | plain s | tuned s | speedup |",
        "| --- | --- | ---: | ---: | ---: |",
    ]
    body = [
        f"| {q['query']} | {q['technique']} | {q['plain_seconds']} | {q['tuned_seconds']} | "
        f"{q['speedup_x']}x |"
        for q in result["per_query"]
    ]
    return "\n".join([*head, *body, ""])


def save_text(spark: SparkSession, path: str, text: str) -> None:
    """Store a small report on any filesystem Spark can reach."""
    lines = [(number, line) for number, line in enumerate(text.splitlines())]
    ordered = spark.createDataFrame(lines, "n INT, value STRING").coalesce(1).sortWithinPartitions("n")
    ordered.select("value").write.mode("overwrite").text(path)


def save(spark: SparkSession, path: str, result: Mapping) -> None:
    save_text(spark, f"{path.rstrip('/')}/json", json.dumps(result, indent=2))
    save_text(spark, f"{path.rstrip('/')}/markdown", as_markdown(result))
