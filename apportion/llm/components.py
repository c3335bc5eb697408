"""Connected components of a distributed edge list by alternating large-star and small-star rounds.

Every round is joins and aggregates on the edges and is written to the shared
folder, so the lineage stays short and nothing is collected. A node with very
many neighbours is aggregated to its minimum map-side; the join that hands the minimum to
its edges is dealt anew, so that Spark can split such a node's edges over several tasks.
Edges with a null end join nothing and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apportion.llm.common import written


def _least(edges: DataFrame) -> DataFrame:
    """(u, least): the smallest neighbour of each node. Grouped by a struct, it is not already dealt by ``u``,
    so a join by ``u`` shuffles both sides and adaptive execution can split a hub."""
    return edges.groupBy(F.struct("u").alias("node")).agg(F.min("v").alias("least")).select("node.u", "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("least", "u").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down).withColumnRenamed("least", "m")
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of the edges (u, v); a component is named by its smallest node."""
    now = written(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        now = written(_small_star(_large_star(now)).where("u <> v").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
        before = state
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
