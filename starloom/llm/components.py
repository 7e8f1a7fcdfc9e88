"""Connected components of a distributed edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import settle


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) of every node of the edges (a, b: long).

    Each round links every node's larger neighbours to its smallest one, then
    every node's smaller neighbours (and itself) to the smallest, until nothing
    changes; the rounds grow with the logarithm of the edges. Minima are
    aggregated before the shuffle, and the joins may be split at a hub.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == mark or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")) \
                .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label"))) \
                .groupBy("node").agg(F.min("label").alias("label"))
        mark = state
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        now = settle(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                     .unionByName(small.select("a", F.col("m").alias("b"))).distinct())
