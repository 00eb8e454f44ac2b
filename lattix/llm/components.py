"""Connected components of a graph given as links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattix.llm.batches import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; the component is its smallest node.

    ``links`` has a and b, in either order, repeated or not; a link of a node to itself gives nothing. Alternates two steps until nothing
    changes: each node hands its larger neighbours to its smallest, then its smaller ones and itself to the smallest
    of those. The number of rounds grows with the logarithm of the longest chain. Minima are aggregated before the
    shuffle, and the joins that follow can be split where a node has very many links. Every round is a written table.
    """
    pairs = written(links.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct())
    before = None
    while True:
        state = pairs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("low", "high").cast("decimal(20,0)")), F.lit(0))).first()
        if state == before:
            break
        before = state
        both = pairs.select(F.col("low").alias("u"), F.col("high").alias("v")).unionAll(pairs.select(F.col("high").alias("u"), F.col("low").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("high"), F.col("m").alias("low")).where("low < high").distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high")
        pairs = written(
            small.where("low <> m").select(F.col("m").alias("low"), F.col("low").alias("high"))
            .unionAll(least.select(F.col("m").alias("low"), "high")).distinct(), instead_of=pairs,
        )
    return pairs.groupBy("high").agg(F.min("low").alias("component")).withColumnRenamed("high", "node").unionAll(pairs.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())
