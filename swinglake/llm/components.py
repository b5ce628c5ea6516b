"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import staged


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node) for every node of ``edges`` (``u``, ``v``).

    Each round hangs nodes nearer to the least node they are known to be linked with; the
    rounds grow with the logarithm of the longest path.  Rounds are written to the shared
    folder, and nothing but a count and a checksum reaches the driver.
    """
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "edges")
    before = None
    while (mark := _fingerprint(now)) != before:
        before = mark
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = staged(small, "edges")
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
        now.select("v", "v").distinct()).groupBy("node").agg(F.min("component").alias("component"))
