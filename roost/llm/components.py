"""Connected components of an edge table, by hooking to the least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.llm.store import keep


def _flattened(parent: DataFrame) -> DataFrame:
    """(id, parent) with every parent a root: double the steps until nothing moves."""
    while True:
        above = parent.select(F.col("id").alias("parent"), F.col("parent").alias("next"))
        stepped = keep(
            parent.join(above, "parent", "left").select(
                "id",
                F.coalesce("next", "parent").alias("parent"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "jumped",
        )
        parent = stepped.select("id", "parent")
        if stepped.filter("moved").isEmpty():
            return parent


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for each end of the edges (a, b); the root is the least id reachable.

    Each round hooks every node to its least smaller neighbour and contracts the edges,
    which at least halves the nodes that still have one. Hubs are pre-aggregated.
    """
    edges = keep(edges.filter("a <> b").distinct(), "edges")
    roots = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    roots = keep(roots.select("id", F.col("id").alias("root")), "roots")
    while not edges.isEmpty():
        least = (
            edges.select(F.greatest("a", "b").alias("id"), F.least("a", "b").alias("parent"))
            .groupBy("id")
            .agg(F.min("parent").alias("parent"))
        )
        parent = _flattened(keep(least, "hooked"))
        up = lambda df, column: (
            df.withColumnRenamed(column, "id")
            .join(parent, "id", "left")
            .withColumn(column, F.coalesce("parent", "id"))
            .drop("id", "parent")
        )
        edges = keep(up(up(edges, "a"), "b").filter("a <> b").distinct(), "edges")
        named = roots.join(parent.withColumnRenamed("id", "root"), "root", "left")
        roots = keep(named.select("id", F.coalesce("parent", "root").alias("root")), "roots")
    return roots
