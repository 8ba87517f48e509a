"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.sources.staging import Staging


def _state(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum over them; equal for equal sets of edges."""
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())


def components(edges: DataFrame, staging: Staging, name: str) -> DataFrame:
    """``node, root`` for every node of the links ``a, b`` (long): the smallest node it reaches.

    Each step joins links with one row per node, so a node of very many links is summed up before
    the shuffle and split in the join. Only counts and sums reach the driver.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    step = 0
    edges = staging.table(edges.distinct(), f"{name}-{step}")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(lowest, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = (
            small.where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b")))
            .distinct()
        )
        step += 1
        after = staging.table(small, f"{name}-{step}")
        now = _state(after)
        staging.drop(f"{name}-{step - 1}")
        edges = after
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
