"""Connected components of links by alternating star contractions, every step a pair of joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component) for every id of the links (a, b); a component is named by its smallest id.

    Each round points every node's larger neighbours at its smallest one, then its smaller ones,
    until nothing changes, in a number of rounds that grows with the logarithm of the longest
    chain. Smallest neighbours are found by partial aggregation, so a node with very many links is
    one row per task before the shuffle, and written; its links stay in a join of two plain shuffles,
    which Spark can split.
    """
    name = uuid.uuid4().hex[:8]
    stars = scratch.put(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}-0",
    )
    step = 0
    while True:
        # larger neighbours to the smallest of the neighbourhood
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        least = scratch.put(least, f"{name}-least")
        large = (
            stars.select(F.col("b").alias("a"), F.col("a").alias("far"))
            .join(least, "a")
            .select(F.col("far").alias("a"), F.col("least").alias("b"))
            .where("a <> b")
            .distinct()
        )
        step += 1
        large = scratch.put(large, f"{name}-{step}")
        # the node and its smaller neighbours to the smallest of them
        least = scratch.put(large.groupBy("a").agg(F.min("b").alias("least")), f"{name}-smaller")
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("x"))
            .select("x.a", "x.b")
            .where("a <> b")
            .distinct()
        )
        step += 1
        stars = scratch.put(small, f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}", f"{name}-{step - 2}")
        # done when every node points at one other, which points nowhere
        pointing = stars.groupBy("a").agg(F.count("*").alias("n"))
        if pointing.where("n > 1").union(pointing.join(stars.select(F.col("b").alias("a")), "a", "left_semi")).isEmpty():
            return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
