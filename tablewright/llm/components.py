"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.shared import Written, written


def _nearest(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, itself included."""
    return edges.groupBy("node").agg(F.min("other").alias("low")).select(
        "node", F.least("node", "low").alias("low")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
    hung = both.join(_nearest(both), "node").where(F.col("other") > F.col("node"))
    return hung.select(F.col("other").alias("node"), F.col("low").alias("other")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    low = _nearest(edges)
    hung = edges.join(low, "node").select(F.col("other").alias("node"), F.col("low").alias("other"))
    return hung.unionByName(low.withColumnRenamed("low", "other")).where("node > other").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("node", "other").cast("decimal(38,0)")),
        ).first()
    )


def connected_components(links: DataFrame, left: str, right: str) -> Written:
    """Rows ``(node, root)`` for every node that has a link and is not its root.

    ``links`` holds unordered pairs of longs; the root is a component's smallest
    node. Nulls and loops are left out, repeated links count once, an empty table
    gives an empty one. Alternating large and small stars: a hub's links are
    joined to one row, which Spark splits when skewed, and its minimum is taken
    per task first. Each round is written, so a lost executor costs one round.
    """
    edges = links.select(
        F.greatest(left, right).alias("node"), F.least(left, right).alias("other")
    ).where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right)))
    now = written(edges.distinct(), "links")
    state = _state(now.table)
    while state[0]:
        after = written(_small_star(_large_star(now.table)), "links")
        now.drop()
        before, now, state = state, after, _state(after.table)
        if state == before:
            break
    return Written(now.table.select("node", F.col("other").alias("root")), now.path)
