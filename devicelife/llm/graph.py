"""Connected components of an undirected graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW, counted, cut


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Node and its component's smallest node, for every node of an edge."""
    e, _ = roots(edges, a, b, rounds)
    top = e.select(F.col("component").alias("node"), "component").distinct()
    return e.unionByName(top)


def roots(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> tuple[DataFrame, int]:
    """Node and its component's smallest node, for every node that is not the smallest itself, and how many they are.

    Alternating large-star and small-star steps: each hooks a node's
    neighbours to the smallest neighbour, so trees halve in height and a hub
    of any degree is only a grouped minimum and an equi-join (which adaptive
    execution splits; of few edges the minima are broadcast instead). Every
    round is checkpointed; the loop ends when all trees are stars.
    """
    e, n = counted(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v"))
    few = n <= FEW
    # few edges may repeat meanwhile (they get no more): that costs less than a shuffle a step
    side, once = (F.broadcast, lambda t: t) if few else (lambda t: t, lambda t: t.distinct())
    e = e if few else cut(once(e))
    for turn in range(rounds + 1):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends, _ = counted(both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("_most")))
        # a star: who has a smaller neighbour has no other
        below, loose = ends.agg(F.count_if(F.expr("m < u")), F.count_if(F.expr("m < u and m <> _most"))).first()
        if not loose:
            return ends.filter("m < u").select(F.col("u").alias("node"), F.col("m").alias("component")), below
        if turn == rounds:
            raise RuntimeError("components did not settle")
        low = ends.select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = once(e.join(side(low), "v").select("u", F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # the edge to the smallest neighbour stays, the others now lead from there
        small = large.join(side(low), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = cut(once(small))
