"""Connected components of a link table by alternating large-star and small-star steps.

Works on (a, b) long pairs only, by aggregates and joins; nothing but a change count
reaches the driver. Every step's table goes to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _min_neighbour(pairs: DataFrame) -> DataFrame:
    """(u, v, m): every pair with the smallest member of u's neighbourhood, u itself included."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
    return pairs.join(low, "u")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return _min_neighbour(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node of its component."""
    e = materialise(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    before = None
    while True:
        e = materialise(_small_star(_large_star(e)).distinct())
        # unchanged edges: every component is a star around its smallest node
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31)), F.bit_xor(F.xxhash64("b", "a"))).first()
        if tuple(state) == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(state)
