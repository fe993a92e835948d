"""Connected components of links, by large-star and small-star rounds.

Every round is two joins with a minimum per node, combined before it is shuffled;
joins on a hot node are split by Spark. Rounds are written as tables, so a lost
executor costs a reread. Only a count and a checksum of a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.plans.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of each node with a link in ``links`` (a, b).

    The component is the least node that links reach. Links from a node to itself and
    links with a null are no links.
    """
    linked = links.filter(F.col("a") != F.col("b"))
    edges = linked.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stage(edges.distinct(), "links")
    told = None
    while (now := _checksum(edges)) != told:
        told = now
        edges = stage(_small_star(_large_star(edges)), "links")
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return found.union(roots.distinct())


def _checksum(edges: DataFrame):
    mark = F.xxhash64("u", "v")
    half = F.sum(F.shiftright(mark, 32))
    return tuple(edges.agg(F.count(F.lit(1)), half, F.sum(mark % 2147483647)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    found = both.filter(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("n"))
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to the least neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    other = least.select(F.col("u").alias("n"), "m")
    found = edges.join(other, F.col("u") == F.col("n")).filter(F.col("v") != F.col("m"))
    found = found.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return found.union(least.select("u", F.col("m").alias("v"))).distinct()
