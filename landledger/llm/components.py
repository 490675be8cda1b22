"""Connected components of a link table, without a large group in any task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landledger.llm.text_tables import narrow
from landledger.storage import materialise


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b long); component is the smallest node reachable.

    Alternating large-star and small-star contraction: each round points every
    node at the smallest node next to it, so long chains shrink in a logarithmic
    number of rounds. A round is an aggregation with map-side combine and a join,
    which adaptive execution splits at hot nodes; no neighbour list is collected.
    Every round is written, so a lost executor costs one round at most.
    """
    edges = materialise(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(),
        "links",
    )
    for _ in range(max_rounds):
        if _are_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v"), F.col("v")).distinct()
            )
        edges = materialise(_small_star(_large_star(edges)), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and no node has both smaller and larger ones."""
    seen = edges.select(F.col("u").alias("node"), F.col("v").alias("parent")).union(
        edges.select(F.col("v"), F.lit(None).cast("long"))
    )
    twisted = seen.groupBy("node").agg(
        F.min("parent").alias("low"), F.max("parent").alias("high"), F.bool_or(F.col("parent").isNull()).alias("centre")
    ).filter("low < high OR (centre AND low IS NOT NULL)")
    return twisted.isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # stored, as below: a join of two exchanges can be split at hot nodes, one on an aggregate cannot
    smallest = materialise(
        narrow(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))), "links"
    )
    # links come out twice at most; the next step folds them
    return both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    edges = materialise(edges, "links")
    smallest = materialise(narrow(edges.groupBy("u").agg(F.min("v").alias("m"))), "links")
    return (
        edges.join(smallest, "u")
        .select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        .filter("u > v")
        .distinct()
    )
