"""Connected components of an edge table: distributed union-find by alternating stars.

Each round hangs every node's larger neighbours, then its smaller ones, on the least neighbour known. Nothing but the
answer whether all nodes hang on roots comes to the driver. A hub with very many edges is aggregated before its shuffle,
checkpointed, and joined back as an input of its own, where Spark can split the hub's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdsift.llm.common import cut


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root, and no root hangs on another node."""
    roots = edges.select(F.col("b").alias("a")).distinct()
    loose = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a").unionByName(
        edges.select("a").join(roots, "a", "left_semi"))
    return loose.isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(cut(least), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return (
        edges.join(cut(least), "a")
        .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def connected(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of an edge (a, b; longs, not null); component is the least id reachable.

    Nodes without an edge do not appear; loops and repeated edges do no harm; no edges give no rows.
    """
    edges = cut(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while not _settled(edges):
        edges = cut(_small_star(_large_star(edges)))
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component")))
