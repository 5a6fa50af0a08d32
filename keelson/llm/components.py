"""Connected components of an edge table by alternating star contractions.

Each round joins the edges with the smallest neighbour of each node (large
star: neighbours above the node; small star: below), which halves the depth of
every component's tree; it ends when a round changes nothing. Minima combine
map-side and the joins are plain equi-joins, so a node with very many edges is
split like any skewed key. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import materialise


def _sums(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 20)))).first())


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``edges`` has columns a, b (long). Returns (node, comp): comp is the
    smallest node of the component. Nodes without an edge don't appear."""
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(spark, edges, "cc")
    before = _sums(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialise(spark, large.filter("a <> b").distinct(), "cc-large")
        down = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(down.select("a", F.col("low").alias("b")))
        edges = materialise(spark, small.filter("a <> b").distinct(), "cc-small")
        now = _sums(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    )
