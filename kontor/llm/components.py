"""Connected components of a distributed edge list.

Alternates large-star and small-star steps (Kiveris et al., "Connected
components in MapReduce and beyond", 2014): each step points a node's
neighbours at the smallest node it knows, and the edges settle into stars
around the smallest node of each component after about log(size) rounds. Every
step is one aggregation and one join on the node; nothing but the edge count
and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontor.llm.common import settle


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """edges: (a, b) with a > b. Every neighbour above a node points at the smallest."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        both.join(_minimum(both), "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, point at the smallest."""
    low = _minimum(edges)
    return (
        edges.join(low, "a")
        .where(F.col("b") != F.col("m"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(low.select("a", F.col("m").alias("b")))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return (r[0], r[1])


def connected_components(links: DataFrame) -> DataFrame:
    """``links``: two columns of one orderable type, an undirected link each.

    Returns (node, component): every node that has a link to another node, with
    the smallest node reachable from it. Nulls, loops and repeated links change
    nothing; no links give an empty result.
    """
    x, y = (F.col(f"`{c}`") for c in links.columns)
    edges = settle(
        links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"), (x != y).alias("real"))
        .where("real")
        .select("a", "b")
        .distinct()
    )
    before = _state(edges)
    while before[0]:
        edges = settle(_small_star(_large_star(edges)))
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
