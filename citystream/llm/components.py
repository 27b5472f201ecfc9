"""Connected components of an edge table by alternating star steps.

Each round lets every node point its larger neighbours, and then itself, at the
smallest node it knows; after a number of rounds that grows with the logarithm
of a component's size every node points at the smallest node of its component.
Each round's edges are checkpointed in the shared folder, so lineage stays
short and a lost executor repeats one round at most. Minima are partial
aggregates, and the join that hands them out is a plain shuffle join that AQE
splits, so a node with very many neighbours is not one task's work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citystream.session import shared_root


def _least(pairs: DataFrame) -> DataFrame:
    """Of each node u: the least of its neighbours and itself."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).checkpoint()
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down).checkpoint()
    return down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node u, v of the edges that isn't the root of its
    component; the root is the component's least node. No edges: no rows."""
    shared_root(edges.sparkSession)
    size = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    now = edges.filter("u != v").select("u", "v").distinct().checkpoint()
    before, after = None, size(now)
    while after[0] and after != before:
        now = _small_star(_large_star(now)).checkpoint()
        before, after = after, size(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
