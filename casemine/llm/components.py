"""Connected components of an edge table by alternating star operations.

Every round hangs the larger neighbours of each node (large star) and then its
smaller ones (small star) under the smallest neighbour, until each component is
one star around its smallest node; that takes a logarithmic number of rounds in
practice.  Minima are partially aggregated before the shuffle and the joins are
plain equi-joins on checkpointed sides, so Spark can split a node that very
many edges share.  Nothing but the two numbers of the stop test reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with ``m``, the least of u's neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, root``: each node of an edge with the smallest node it reaches."""
    pairs = cut(edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
                .where("u <> v").distinct())
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_with_least(both).where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        small = _with_least(large.where("u > v"))
        small = (small.select("u", F.col("m").alias("v"))
                 .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                 .distinct())
        pairs = cut(small)
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
