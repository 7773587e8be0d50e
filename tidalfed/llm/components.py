"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalfed.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of each linked node but the smallest.

    ``links`` has long columns ``a`` and ``b``. Large-star and small-star steps alternate
    until the links are stars around the smallest node of each component. Each step groups
    and joins by node; a node with many neighbours is pre-aggregated and its join may be split.
    """
    pairs = settled(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .filter("u <> v").distinct(), "links")
    before = state(pairs)
    while before[0]:
        both = pairs.union(pairs.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = settled(small.filter("u <> v").union(least).distinct(), "links")
        now = state(pairs)
        if now == before:
            break
        before = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))


def state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
                 .first())
