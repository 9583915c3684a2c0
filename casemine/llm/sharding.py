"""Reproducible shuffle into shards: a Feistel permutation of row numbers.

Rows get a global row number 0..n-1 in the order of (doc_id, text bytes' crc,
size, text hash).  The permutation works on the grid a x b, a = ceil(sqrt(n)),
b = ceil(n / a): the number is split into (l, r) and each round adds a keyed
hash of one half to the other, modulo its side, which can always be undone.
The grid holds fewer than ``a`` places beyond n; a number that lands there
walks on (applies the permutation again) until it is below n, so 0..n-1 is
permuted onto itself.  Place p of the shuffle is slot ``p div shards`` of shard
``p mod shards``: shard and slot of a row number need no table, and shard
sizes differ by one row at most (law ``rows``).

Only built-in column functions; one range shuffle of (doc_id, size, crc, hash).

Edge cases: null text counts as empty (size 8, crc 0); null doc_ids come first;
equal rows are interchangeable, each gets its own slot; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import row_number_within
from .common import text_size

ROUNDS = 6
WALK = 32


def _permute_once(x: Column, a: int, b: int, seed: int) -> Column:
    """The grid permutation of x in [0, a * b)."""
    def step(state, k):
        salt = F.lit(seed)
        left = F.pmod(state["l"] + F.pmod(F.xxhash64(state["r"], k, salt), F.lit(a)), F.lit(a))
        right = F.pmod(state["r"] + F.pmod(F.xxhash64(state["l"], k, salt), F.lit(b)), F.lit(b))
        even = k % 2 == 0
        return F.struct(F.when(even, left).otherwise(state["l"]).alias("l"),
                        F.when(even, state["r"]).otherwise(right).alias("r"))
    # the dividend is a multiple of b, so the quotient is exact below 2^53
    first = F.struct(F.floor((x - F.pmod(x, F.lit(b))) / F.lit(b)).cast("long").alias("l"),
                     F.pmod(x, F.lit(b)).alias("r"))
    rounds = F.array(*[F.lit(k) for k in range(ROUNDS)])
    return F.aggregate(rounds, first, step, lambda s: s["l"] * F.lit(b) + s["r"])


def permute(x: Column, n: int, seed: int) -> Column:
    """Bijection of [0, n) onto itself: the grid permutation with cycle walking.

    A walk leaves [0, n) with a chance of about 1/sqrt(n) per step and at most
    ``a * b - n`` times in a row, so the second, full-length walk makes the
    result exact while hardly any row ever enters it."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    b = max(1, -(-n // a))
    spare = a * b - n
    if spare == 0:
        return _permute_once(x, a, b, seed)

    def walk(start: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start,
                           lambda p, _: F.when(p < n, p).otherwise(_permute_once(p, a, b, seed)))

    first = walk(_permute_once(x, a, b, seed), min(WALK, spare + 1))
    if spare + 1 <= WALK:
        return first
    return F.transform(F.array(first), lambda p: F.when(p < n, p).otherwise(walk(p, spare + 1)))[0]


def shard(docs: DataFrame, shards: int, seed: int = 17, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row per
    row of ``docs``; ``grown_shard`` is null as the law is ``rows``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (text_size(text) + 8).alias("size"),
                       F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("_h"),
                       F.rand(seed).alias("_r"))  # deals equal rows over the ranges
    numbered = row_number_within(rows, [], [F.col("doc_id"), F.col("text_crc32"), F.col("size"),
                                            F.col("_h"), F.col("_r")], name="_row", size_name="_n")
    n = numbered.select("_n").first()
    if n is None:
        return _shaped(rows.limit(0), F.lit(0).cast("long"), shards)
    place = permute(F.col("_row") - 1, n[0], seed)
    return _shaped(numbered.withColumn("_place", place), F.col("_place"), shards)


def _shaped(df: DataFrame, place: Column, shards: int) -> DataFrame:
    return df.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                     F.pmod(place, F.lit(shards)).cast("int").alias("shard"),
                     ((place - F.pmod(place, F.lit(shards))) / shards).cast("long").alias("slot"),
                     F.lit(None).cast("int").alias("grown_shard"))
