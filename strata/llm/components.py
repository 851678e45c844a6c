"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import discard, stored

#: Rounds shorten every path at least by half; 60 suffice for any graph that can be stored.
MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for the nodes of ``edges`` (a, b: long).

    Alternating rounds: every node tells its larger neighbours of its smallest one, then its
    smaller neighbours, until only stars are left. Each round is two aggregations by node, both
    combined before their shuffles, and writes the edges, so a lost executor repeats one round.
    """
    edges = stored(_oriented(edges))
    for _ in range(MAX_ROUNDS):
        if _are_stars(edges):
            break
        halfway = _large_star(edges)
        discard(edges)
        edges = _small_star(halfway)
        discard(halfway)
    else:
        raise RuntimeError("components did not settle")
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return leaves.union(roots)


def _are_stars(edges: DataFrame) -> bool:
    """Every larger end has one edge and is the smaller end of none."""
    ends = edges.select(F.col("a").alias("v"), F.lit(0).alias("up")).union(edges.select("b", F.lit(1)))
    seen = ends.groupBy("v").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
    return seen.filter("up > 1 or (up = 1 and low = 0)").isEmpty()


def _oriented(edges: DataFrame) -> DataFrame:
    """a < b, each edge once."""
    return (
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.union(edges.select("b", "a"))
    # Stored, so that a node with very many edges can be split in the join.
    least = stored(both.groupBy("a").agg(F.min("b").alias("m")))
    # Only larger neighbours move: the pairs (a, b) with a < b as they are.
    found = stored(edges.join(least, "a").select(F.least("a", "m").alias("a"), "b").distinct())
    discard(least)
    return found


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them."""
    least = stored(edges.groupBy("b").agg(F.min("a").alias("m")))
    moved = edges.join(least, "b")
    ends = F.explode(F.array("a", "b")).alias("c")
    found = moved.select(F.col("m").alias("a"), ends).filter("a <> c").select("a", F.col("c").alias("b")).distinct()
    found = stored(found)
    discard(least)
    return found
