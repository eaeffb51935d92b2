"""What the scans of a query read and its shuffles wrote, from its metrics after a run."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Scan:
    """One file scan: files opened, and rows handed on before any filter.

    Rows of skipped row groups are never handed on, so against the rows of the files they
    tell how much the bounds of row groups saved.
    """

    path: str
    files: int
    rows: int


def _nodes(node: JavaObject) -> Iterator[JavaObject]:
    """The nodes of the plan that ran, through adaptive stages."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _nodes(node.finalPhysicalPlan())
    elif kind.endswith("QueryStageExec"):
        yield from _nodes(node.plan())
    else:
        yield node
        children = node.children()
        for i in range(children.size()):
            yield from _nodes(children.apply(i))


def scans_of(df: DataFrame) -> list[Scan]:
    """File scans of ``df``, which has to have been run by an action on itself."""
    found = []
    for node in _nodes(df._jdf.queryExecution().executedPlan()):
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            metric = lambda name, node=node: int(node.metrics().apply(name).value())
            roots = node.relation().location().rootPaths()
            found.append(Scan(roots.apply(0).toString(), metric("numFiles"), metric("numOutputRows")))
    return found


def shuffled_bytes(df: DataFrame) -> int:
    """Bytes that the shuffles of ``df`` wrote; it has to have been run by an action on itself."""
    return sum(
        int(node.metrics().apply("shuffleBytesWritten").value())
        for node in _nodes(df._jdf.queryExecution().executedPlan())
        if node.getClass().getSimpleName() == "ShuffleExchangeExec"
    )
