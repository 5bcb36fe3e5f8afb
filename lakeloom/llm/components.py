"""Connected components of an edge table, by DataFrame joins.

The alternating star contraction: a large-star step links every larger neighbour
of a vertex to the least vertex it knows, a small-star step does so for the
vertex and its smaller neighbours. Both use a grouped minimum (combined before
the shuffle) and a join that adaptive execution can split, so no vertex's
neighbours are ever gathered. The number of rounds grows with the logarithm of
the number of vertices; every round is written to the shared checkpoint folder.
They end when the vertices' neighbours, counted for the next round, are those of stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, forgotten


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(both: DataFrame, known: DataFrame) -> DataFrame:
    """Repeats stay: there are no more of them than edges, and the small-star step drops them."""
    least = known.select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Of edges that run from larger ``u`` to smaller ``v``."""
    least = _least(edges)
    linked = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``u``, ``v`` pairs to ``node``, ``root``: the least vertex of each component.

    Vertices are comparable values. Null ends and loops are no edges; repeated
    edges count once; a vertex without edges is not in the result; an empty table
    gives an empty result.
    """
    work = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    work = checkpointed(work)
    for _ in range(most_rounds):
        both = work.unionByName(work.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written before the join: both sides are then dealt for it alone, and a hub's many edges can be split.
        known = checkpointed(both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") < F.col("u")).alias("smaller"), F.count("*").alias("every")))
        forgotten(known)
        # Stars: who knows a smaller vertex knows no other.
        if known.where("smaller > 0 AND every > 1").isEmpty():
            return work.select(F.col("u").alias("node"), F.col("v").alias("root"))
        work = checkpointed(_small_star(_large_star(both, known)))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
