"""Connected components of a link table, by stars that grow and fold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import landed_parquet


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).select(F.col("a").alias("u"), "m")
    out = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them (a > b in every edge)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
    out = edges.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and sums of two hashes: equal for equal sets of edges (sums as decimals never overflow)."""
    h = [F.sum(F.xxhash64("a", "b", F.lit(s)).cast("decimal(38,0)")) for s in (0, 1)]
    return tuple(edges.agg(F.count(F.lit(1)), *h).first())


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node that links reach, for every node of the
    edges (a, b); loops and rows with nulls are left out.

    Large and small stars in turn until the edges stay as they are: then each
    node links to its component's smallest.  A chain's links halve each round,
    so rounds grow with the logarithm of its length.  Every star's edges are
    written and read back, so plans and their size estimates stay as small as
    in the first round; only counts and sums reach the driver."""
    a, b = F.greatest("a", "b"), F.least("a", "b")
    edges = landed_parquet(edges.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "star")
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    mark = _mark(edges)
    while True:
        grown = landed_parquet(_large_star(edges), "star")
        edges = landed_parquet(_small_star(grown), "star")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    stars = edges.select(F.col("a").alias("__leaf"), F.col("b").alias("label"))
    return nodes.join(stars, F.col("node") == F.col("__leaf"), "left").select("node", F.coalesce("label", "node").alias("label"))
