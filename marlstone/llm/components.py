"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.storage import stored

MAX_ROUNDS = 60


def _with_smallest(pairs: DataFrame) -> DataFrame:
    """Every pair (node, other) with the smallest of the node and its others.

    Smallest values are combined before the shuffle; the join after it is one
    that adaptive execution splits where a node is hot.
    """
    smallest = pairs.groupBy("node").agg(F.min("other").alias("m")).select(
        "node", F.least("m", "node").alias("m"))
    return pairs.join(smallest, "node")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    return _with_smallest(both).where("other > node").select(
        F.col("other").alias("b"), F.col("m").alias("a")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    linked = _with_smallest(down)
    return linked.select(F.col("m").alias("a"), F.col("other").alias("b")).unionByName(
        linked.select(F.col("m").alias("a"), F.col("node").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    ``edges`` has columns a < b. Rounds are written to the shared folder, and
    end when the star of every component is reached.
    """
    current = stored(edges.select("a", "b").distinct(), label)
    before = None
    for _ in range(MAX_ROUNDS):
        current = stored(_small_star(_large_star(current).distinct()), label)
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    else:
        raise RuntimeError(f"components have not settled in {MAX_ROUNDS} rounds")
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
