"""Connected components by alternating large and small stars, as joins and group minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailfacts.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Connect each node's larger neighbours (or its smaller ones and itself) with its minimum.

    The minima are aggregated before the shuffle and stored, so that the join back is between two
    plain shuffles, in which Spark splits a node with very many neighbours."""
    if small:
        both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    low = stored(both.groupBy("u").agg(F.least(F.min("v"), "u").alias("m")), "star-minima")
    joined = both.join(low, "u")
    if small:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            low.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = out.unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b): the smallest node reachable.

    Rounds are logarithmic in the longest path. Each is written to the shared folder, so a lost
    executor costs one round at most; only a count and a checksum come to the driver."""
    current, before = edges.where("a <> b").select("a", "b").distinct(), None
    while True:
        current = stored(_star(stored(_star(current, small=False), "star-large"), small=True), "star-small")
        now = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
