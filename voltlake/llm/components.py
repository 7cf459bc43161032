"""Connected components by joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    # Written, so that the join is one of two plain shuffles, of which a hub's rows can be split.
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    m = F.least("u", "m")
    return both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("hi"), m.alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = staged(edges.groupBy("hi").agg(F.min("lo").alias("m")), "least")
    moved = edges.join(least.hint("merge"), "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo")))


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the smallest node.

    Large stars and small stars take turns until nothing changes, which takes a number of rounds
    near the logarithm of a component's size. Each round is a written table, so a hub's
    edges are rows of a join and never one task's list.
    """
    edges = staged(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct(),
        "edges",
    )
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.pmod(F.xxhash64("lo", "hi"), F.lit(1 << 30)))).first()
        if state == seen or not state[0]:
            break
        seen = state
        wide = _large_star(edges).where("hi > lo").distinct()
        edges = staged(_small_star(wide).where("hi > lo").distinct(), "edges")
    roots = edges.select("lo").distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        roots.select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    )
