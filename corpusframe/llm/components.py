"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusframe.sources.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter(F.col("b") > F.col("m"))
    return least.select("a", F.col("m").alias("b")).union(moved.select(F.col("b").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots; a root is its component's least node.

    Each round links every node to the least neighbour it knows, first upwards, then downwards,
    and is written to the shared folder; the rounds are about the logarithm of the longest chain.
    Only a count and a checksum reach the driver. An empty table gives no rows.
    """
    at = edges.filter(F.col("a") != F.col("b"))
    at = written(at.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    seen = mark(at)
    while True:
        at = written(_small_star(_large_star(at)).distinct(), "stars")
        now = mark(at)
        if now == seen:
            return at.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
