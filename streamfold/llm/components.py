"""Connected components of an edge table, by alternating star contractions.

Every round is a few joins and grouped minima over the edges, written to the
shared checkpoint folder; nothing is collected.  A hub with many edges is
pre-aggregated in the grouped minima, and the minima are written before they
are joined: both sides of a join are then plain exchanges, which Spark's skew
join can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfold.llm.common import scratch


def _lowest(edges: DataFrame) -> DataFrame:
    return scratch(edges.groupBy("x").agg(F.min("y").alias("m")), "lowest")


def _to_lowest(edges: DataFrame, low: DataFrame) -> DataFrame:
    return edges.join(low, "x")


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (x, y), y < x."""
    both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    low = _lowest(both)
    # large star: each larger neighbour of x goes to the smallest node near x
    large = scratch(_to_lowest(both.filter(F.col("y") > F.col("x")), low)
                    .select(F.col("y").alias("x"), F.least("x", "m").alias("y")).distinct(), "edges")
    # small star: x and its smaller neighbours go to the smallest of them
    low = _lowest(large)
    small = _to_lowest(large, low).filter(F.col("y") != F.col("m")).select(F.col("y").alias("x"), F.col("m").alias("y"))
    return small.unionByName(low.select("x", F.col("m").alias("y"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("x", "y")).alias("h"),
                  F.sum((F.xxhash64("y", "x") % 1_000_003)).alias("s")).first()
    return (r["n"], r["h"], r["s"])


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges over orderable ids to (node, component): the smallest id
    reachable.  Only nodes with an edge to another node appear; loops, null
    ends and repeated edges add nothing."""
    cur = (edges.filter(F.col("a") != F.col("b"))
           .select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct())
    cur = scratch(cur, "edges")
    seen = _mark(cur)
    while seen[0]:
        cur = scratch(_round(cur), "edges")
        now = _mark(cur)
        if now == seen:
            break
        seen = now
    out = cur.select(F.col("x").alias("node"), F.col("y").alias("component"))
    return out.unionByName(cur.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct())


def local_stars(n: int, i, j):
    """Within one task: edges i-j between items 0..n-1 to an array with the
    smallest item each reaches."""
    import numpy as np

    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root
