"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubwell.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it sees."""
    both = edges.union(edges.select("low", "high")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    return (
        both.filter("other > node")
        .join(least, "node")
        .select(F.col("other").alias("high"), F.least("node", "least").alias("low"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").filter("low > least").select("low", "least")
    return moved.toDF("high", "low").union(least.toDF("high", "low"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node that has an edge; the smallest node names its component.

    ``edges`` has two bigint columns of any names; direction, repeats and loops
    do not matter, rows with a null are no edges.  Large-star and small-star
    rounds take turns until nothing moves: about log(size) rounds, each two
    aggregates and two joins over no more rows than there are edges.  Each round
    is written to the shared folder, so the lineage stays short and a lost
    executor costs one round at most.
    """
    first, second = edges.columns
    current = (
        edges.filter(F.col(first) != F.col(second))
        .select(F.greatest(first, second).alias("high"), F.least(first, second).alias("low"))
        .distinct()
    )
    current = stage(current, "edges")
    before, mark = None, _mark(current)
    while mark != before and mark[0]:
        current = stage(_small_star(_large_star(current).distinct()).distinct(), "edges")
        before, mark = mark, _mark(current)
    roots = current.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return current.toDF("node", "component").union(roots)
