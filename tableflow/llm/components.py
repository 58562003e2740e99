"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.session import materialise, release


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a and b, longs): the label is the smallest
    node that can be reached.

    A large star ties the larger neighbours of a node to the smallest one around it, a small star
    the smaller ones; in turn they leave stars only, after a number of rounds that grows with the
    logarithm of the graph. The smallest neighbour is found by an aggregate with partial sums, so a
    node with very many edges does not meet in one task. Loops and repeated edges change nothing.
    """
    pairs = materialise(_larger_first(edges.select("a", "b")))
    before = None
    while (now := _signature(pairs)) != before:
        before, old = now, pairs
        pairs = materialise(_small_star(_large_star(old)))
        release(old)
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


def _larger_first(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _signature(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("near")).select("a", F.least("a", "near").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("a").agg(F.min("b").alias("least"))
    ties = pairs.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _larger_first(ties.unionByName(least.select("a", F.col("least").alias("b"))))
