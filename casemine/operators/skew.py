"""Joins on a key that may be hot (one term in a third of all rows).

A key is hot when it holds more than 1/(4 P) of the big side's rows, P being
the shuffle partition count; so there are at most 4 P hot keys (a proven
bound: they are collected with their counts).  Rows of a hot key on the big
side are dealt over as many buckets as the key has shares of rows / P, by a hash
of their other columns (so a recomputed task assigns the same bucket); the small
side's rows of a hot key are replicated once per bucket; the join runs on (key,
bucket).  Every big row still meets all small rows of its key, so inner, left,
semi and anti joins give the same rows as without salting.  A big side of keys
only is joined as counts, which are rolled out again afterwards.  Semi and anti
joins hash the small side's keys, so that no task sorts its rows of the big side.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS_ONLY = ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti")


def hot_keys(big: DataFrame, key: str, partitions: int | None = None) -> dict:
    """Hot key -> number of buckets, from one aggregation of the big side."""
    counts = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.persist(StorageLevel.DISK_ONLY)  # the big side is counted once
    hot = hot_of_counts(counts, key, "_n", partitions)
    counts.unpersist()
    return hot


def hot_of_counts(counts: DataFrame, key: str, n: str, partitions: int | None = None) -> dict:
    """The same from the big side's rows per key, where they are known (read twice)."""
    p = partitions or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(n)).first()[0] or 0
    found = counts.where((F.col(n) * 4 * p > total) & F.col(key).isNotNull()).select(key, n).collect()  # at most 4 P rows
    return {r[key]: math.ceil(r[n] * p / total) for r in found}


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                hot: dict | None = None) -> DataFrame:
    """``big.join(small, key, how)`` with hot keys of ``big`` dealt over tasks."""
    hot = hot_keys(big, key) if hot is None else hot
    hot = {k: n for k, n in hot.items() if n > 1}
    if how in KEYS_ONLY:
        small = small.select(key).hint("shuffle_hash")
    if not hot:
        return big.join(small, key, how)
    buckets: Column = F.lit(1)
    for n in sorted(set(hot.values())):
        buckets = F.when(F.col(key).isin([k for k, m in hot.items() if m == n]), F.lit(n)).otherwise(buckets)
    others = [c for c in big.columns if c != key]
    if not others:  # equal rows: one counted row per key and bucket
        counted = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).withColumn("_i", F.explode(
            F.sequence(F.lit(0), buckets - 1))).withColumn("_b", buckets.cast("long"))
        share = F.floor((F.col("_n") + F.col("_b") - 1 - F.col("_i")) / F.col("_b")).cast("int")
        rolled = counted.join(small, key, how).repartition(key, "_i").where(share > 0)
        return rolled.withColumn("_i", F.explode(F.sequence(F.lit(1), share))).drop("_n", "_i", "_b")
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in others]), buckets.cast("long")))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), buckets - 1).cast("array<long>")))
    out = b.join(s.hint("shuffle_hash") if how in KEYS_ONLY else s, [key, "_salt"], how).drop("_salt")
    if how in KEYS_ONLY:
        return out.select(key, *others)  # the column order of a plain join
    return out
