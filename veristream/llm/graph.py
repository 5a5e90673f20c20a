"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veristream.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id with an edge.

    ``edges`` has whole numbers ``a`` and ``b``; loops, repeats and nulls do no harm.  Each round
    hangs every node's neighbours on its smallest one; the written result of a round is the next
    one's input.  The number of rounds grows with the logarithm of the longest chain.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = materialize(e, "edges"), None
    while True:
        size = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first())
        if size == before or size[0] == 0:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("component"))
            ).groupBy("id").agg(F.min("component").alias("component"))
        before = size
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialize(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large"
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e = materialize(
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct(), "small",
        )
