"""Connected components of links between longs, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import discard, written


def _to_least(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Hang neighbours of each node on the least of them: the larger ones (both ways given), else the smaller ones and the node."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if both_ways:
        pairs = pairs.unionAll(edges.select("b", "a"))
    least = pairs.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select("u", F.least("u", "low").alias("low"))
    joined = pairs.join(least, "u")
    if both_ways:
        moved = joined.filter("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("low").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("low").alias("b")))
    return moved.filter("a <> b").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, least) for each end of a link (columns a, b): the least node it is connected with.

    Links may come in either direction and repeat.  Each round hangs every node on the least neighbour of its neighbours
    and is written to the shared folder; rounds grow with the logarithm of the longest path.  Nodes with very many links
    are aggregated before the shuffle and joined, never gathered.  The result can be discarded like a written table.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), spark)
    state = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = state(edges)
    while True:
        shorter = written(_to_least(_to_least(edges, True), False), spark)
        discard(edges)
        edges = shorter
        after = state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("least"))
    out = stars.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("least")).distinct())
    out.touchline_path = edges.touchline_path
    return out
