"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetrail.session import materialized


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of an edge with the smallest node reachable from it.

    Large-star and small-star steps alternate until no edge changes; each step is one aggregation and one
    join, so a node with many edges is summed in parts before the shuffle. Every round is written, which
    cuts the lineage. Self-edges and null ends are ignored; repeated edges do not matter.
    """
    now = materialized(
        edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .filter((F.col(a) != F.col(b)) & F.col(a).isNotNull() & F.col(b).isNotNull())
        .distinct()
    )
    state = _state(now)
    while state[0]:
        both = now.union(now.select("low", "high"))
        least = both.groupBy("high").agg(F.min("low").alias("_least"))
        least = least.withColumn("_least", F.least("high", "_least"))
        # Large star: each larger neighbour is tied to the smallest one.
        star = (
            both.select("high", "low")
            .join(least, "high")
            .filter(F.col("low") > F.col("high"))
            .select(F.col("low").alias("high"), F.col("_least").alias("low"))
            .filter(F.col("high") != F.col("low"))
            .distinct()
        )
        star = materialized(star)
        # Small star: each smaller neighbour, and the node itself, is tied to the smallest one.
        least = star.groupBy("high").agg(F.min("low").alias("_least"))
        tied = star.join(least, "high")
        now = materialized(
            tied.select("high", F.col("_least").alias("low"))
            .union(tied.filter(F.col("low") != F.col("_least")).select("low", "_least"))
            .distinct()
        )
        before, state = state, _state(now)
        if before == state:
            break
    rows = now.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return rows.union(now.select("low", "low").distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes: equal for equal edge sets."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(20,0)"))).first()
    return row[0], row[1]
