"""Connected components of a link table, with Spark joins only."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written


def _min_joined(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its partners. The minimum is aggregated before the shuffle, and the join
    back is an ordinary one, so a hub with very many partners is split like any skewed key."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), "m")
    return pairs.join(least, F.col("u") == F.col("_u")).select("u", "v", F.least("u", "m").alias("m"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node in ``links``; root is the smallest node it can reach.

    Alternates the large-star and small-star steps of Kiveris et al. (2014): each joins nodes to the smallest partner
    until only stars are left, in about the logarithm of the longest path. Every round is a table in the shared folder,
    so lineage stays short. Links from a node to itself and repeated links do no harm.
    """
    def large(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        return _min_joined(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        joined = _min_joined(down)
        return (joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(joined.select(F.col("u").alias("a"), F.col("m").alias("b"))))

    def tidy(e: DataFrame) -> DataFrame:
        return e.where("a <> b").distinct()

    edges = written(tidy(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))), "edges")
    mark = _mark(edges)
    for _ in range(max_rounds):
        edges = written(tidy(small(tidy(large(edges)))), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
