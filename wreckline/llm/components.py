"""Connected components of an edge list, by alternating large and small stars.

Every step is a grouped minimum (combined before the shuffle) and an equi-join whose
skewed keys adaptive execution splits; each round is written to the shared folder, so no
lineage builds up. Rounds grow with the logarithm of the longest path, not its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _star(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with u's least neighbour, or u itself if that is less, as m.

    The minima are written before the join: adaptive execution splits a hub's edges over
    tasks only where both sides of a join come straight from a shuffle.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(staged(least, "least"), "u")


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges (u, v) with v < u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = _star(large)
    hooked = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
    return hooked.where("u <> v").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a root, and no root has any: nothing is left to do."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node of its
    component. Edges may repeat, in either direction; loops and nulls are ignored; no
    edges give no rows."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = staged(now, "edges")
    while not _stars(now):
        now = staged(_round(now), "edges")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
