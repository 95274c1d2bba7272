"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countyloom.llm.common import checkpointed, gathered

MOST_ROUNDS = 100


def _large(edges: DataFrame, count: int) -> DataFrame:
    """Every node passes its least neighbour on to its larger neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    passed = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return gathered(gathered(passed, count).distinct(), count)


def _small(edges: DataFrame, count: int) -> DataFrame:
    """Every node joins itself and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    joined = gathered(others, count).unionByName(gathered(least.select("a", F.col("m").alias("b")), count))
    return gathered(joined.distinct(), count)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the least node that can be reached.

    Each round is written to the shared folder; rounds grow with the logarithm of the largest component. Hot nodes are
    joined, not gathered: least neighbours are found before the shuffle. Loops and repeated edges are harmless. Edges never
    grow in number, so a round takes as many tasks as they need, whatever the shuffle's partitions.
    """
    plain = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = checkpointed(plain), None
    for _ in range(MOST_ROUNDS):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before, count = mark, mark[0]
        now = checkpointed(_small(_large(gathered(now, count), count), count))
    else:
        raise RuntimeError(f"components are not finished after {MOST_ROUNDS} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
