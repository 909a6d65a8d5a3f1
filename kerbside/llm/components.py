"""Connected components by alternating large-star and small-star, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import discard, stored


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of a node and its neighbours; combined in each task before the shuffle."""
    return stored(pairs.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), "star-roots")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and a node that has one is nobody's centre."""
    ends = edges.select(F.greatest("u", "v").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high"))
    ends = ends.unionByName(edges.select(F.least("u", "v").alias("node"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    counted = ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return counted.where("low > 1 or (low = 1 and high = 1)").isEmpty()


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    roots = _smallest(both)
    moved = both.where("v > u").join(roots, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.distinct(), roots


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    roots = _smallest(down)
    linked = down.join(roots, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(roots.select("u", F.col("m").alias("v"))).distinct(), roots


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): every node that has an edge, with the smallest node it is connected to.

    Each round links all larger neighbours of a node to its smallest neighbour (large-star) and then
    all smaller ones (small-star), until the edges are stars; the number of rounds grows with the
    logarithm of the longest path. Roots are found by a combined minimum, and edges meet them in a
    join of two stored tables, whose hot keys Spark can split: no neighbourhood is ever gathered.
    Each round's edges are written to the shared folder, and those before are deleted.

    Nulls are no nodes; a loop (a node linked to itself) makes a component of that one node. An empty
    table of edges gives no rows. Works for any type that can be ordered.
    """
    given = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null")
    now = stored(given.distinct(), "edges")
    loops = now.where("u = v").select(F.col("u").alias("node"))
    now, held = now.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), []
    while not _are_stars(now):
        large, roots = _large_star(now)
        large = stored(large, "large-star")
        next_, more_roots = _small_star(large)
        next_ = stored(next_, "small-star")
        for old in (*held, roots, large, more_roots):
            discard(old)
        held, now = [next_], next_
    tails = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    heads = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    alone = loops.join(tails.select("node"), "node", "left_anti").join(heads.select("node"), "node", "left_anti")
    return tails.unionByName(heads).unionByName(alone.select("node", F.col("node").alias("component")))
