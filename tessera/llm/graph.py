"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import remove, written


def _stars(edges: DataFrame, small: bool, name: str) -> DataFrame:
    """One star step: a node's neighbours (smaller ones only, or all) go to its least neighbour.

    The least one comes from an aggregate with partial results on the map side. It is grouped
    by the node's complement and turned back, so that its rows don't count as dealt by node:
    both sides of the join are then plain shuffles, and a node with a large share of all edges
    can be split.
    """
    if small:
        to = edges.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("m"))
    else:
        to = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).unionAll(
            edges.select(F.col("b").alias("n"), F.col("a").alias("m")))
    least = to.groupBy(F.bitwise_not("n").alias("flipped")).agg(F.min("m").alias("m")).select(
        F.bitwise_not("flipped").alias("n"), F.least(F.col("m"), F.bitwise_not("flipped")).alias("r"))
    met = to.join(least, "n")
    if small:
        new = met.select(F.col("m").alias("a"), F.col("r").alias("b")).unionAll(
            least.select(F.col("n").alias("a"), F.col("r").alias("b")))
    else:
        new = met.where(F.col("m") > F.col("n")).select(F.col("m").alias("a"), F.col("r").alias("b"))
    return written(new.where("a <> b").distinct(), name)


def _settled(edges: DataFrame) -> bool:
    """Whether distinct edges (a, b), a > b, are separate stars around their least nodes: each a has one b, which is no a."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not nodes.where("out > 1 or out = 1 and into = 1").count()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, label (least node of its component) of every node in ``edges`` (a, b: longs).

    Rounds of a large and a small star until only separate stars are left, a number that
    grows with the logarithm of the size. Each step's edges are written to the shared folder.
    Loops and repeated edges are fine; no edges give no rows.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    now = written(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), name)
    while not _settled(now):
        large = _stars(now, False, name)
        last, now = now, _stars(large, True, name)
        for old in (last, large):
            remove(now.sparkSession, old._written_to)
    # every edge now joins a node to its component's least one
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
