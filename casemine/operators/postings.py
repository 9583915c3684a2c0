"""Posting lists in blocks: which keys hold a word, without a list of unbounded
length in any row or task.

A pair (key, member) says that the member (an id) belongs to the key's list.
A block holds the members of a key within one range of ``WIDTH`` ids, so it has
``WIDTH`` of them at most whatever the key, and its number follows from an id
alone: lists are made by one aggregation on (key, block) that is combined before
the shuffle, looked up by an equi-join, and intersected block by block inside
the row.  Members are stored as distances from the block's start, small ascending
numbers that column files keep in few bits.

Edge cases: repeated pairs count once; null keys or members are left out; ids
may be negative; an empty table has no blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .broadcast import join_small

WIDTH = 4096


def block_of(member: Column, width: int = WIDTH) -> Column:
    """The number of the block that an id falls into."""
    return ((member - F.pmod(member, F.lit(width))) / F.lit(width)).cast("long")


def blocks(pairs: DataFrame, key: str, member: str, width: int = WIDTH) -> DataFrame:
    """(key, block, n, deltas array<int>): the lists of ``pairs`` cut into
    blocks; ``deltas``: the members' distances from ``block * width``, ascending."""
    m = F.col(member).cast("long")
    rows = pairs.select(F.col(key).alias(key), block_of(m, width).alias("block"),
                        F.pmod(m, F.lit(width)).cast("int").alias("delta")).dropna()
    lists = rows.groupBy(key, "block").agg(F.array_sort(F.collect_set("delta")).alias("deltas"))
    return lists.select(key, "block", F.size("deltas").cast("long").alias("n"), "deltas")


def members(width: int = WIDTH) -> Column:
    """The members of a block (array<long>)."""
    return F.transform("deltas", lambda d: F.col("block") * F.lit(width) + d)


def pairs_of(lists: DataFrame, key: str, member: str, width: int = WIDTH) -> DataFrame:
    """The pairs that blocks hold."""
    return lists.select(key, F.explode(members(width)).alias(member))


def inverted(lists: DataFrame, key: str, member: str, numbers: DataFrame, number: str, width: int = WIDTH) -> DataFrame:
    """The lists the other way round: per member the blocks of its keys, which
    are written as numbers (``numbers``: key, number).  The join moves blocks,
    so a key in a third of all pairs is few rows here."""
    numbered = lists.join(numbers.select(key, number), key)
    return blocks(numbered.select(number, F.explode(members(width)).alias(member)), member, number, width)


def _asked(asked: DataFrame, query: str, key: str) -> tuple[DataFrame, DataFrame]:
    once = asked.select(query, key).dropna().distinct()
    return once, once.groupBy(query).agg(F.count(F.lit(1)).alias("wanted"))


def holding(lists: DataFrame, key: str, member: str, asked: DataFrame, query: str, width: int = WIDTH) -> DataFrame:
    """(query, member, hits, wanted): the members that hold at least one of the
    keys that a query asks for (``asked``: query, key), how many of them they
    hold and how many different ones were asked for."""
    once, wanted = _asked(asked, query, key)
    found = lists.join(once, key).select(query, F.explode(members(width)).alias(member))
    hits = found.groupBy(query, member).agg(F.count(F.lit(1)).alias("hits"))
    return join_small(hits, wanted, query, "inner").select(query, member, "hits", "wanted")


def holding_all(lists: DataFrame, key: str, member: str, asked: DataFrame, query: str, width: int = WIDTH) -> DataFrame:
    """(query, member): the members that hold all keys of a query.  Blocks of
    its keys meet by number; where all keys have one, they are intersected in
    the row."""
    once, wanted = _asked(asked, query, key)
    # how many keys are wanted comes along with each; the lists, the larger side, are not sorted
    keys = once.join(wanted, query).hint("shuffle_hash")
    # dealt as they are: few of a query's lists meet before they are dealt
    met = lists.join(keys, key).select(query, "block", "deltas", "wanted").repartition(query, "block").groupBy(query, "block").agg(
        F.collect_list("deltas").alias("lists"), F.max("wanted").alias("wanted"))
    full = met.where(F.size("lists") == F.col("wanted"))
    both = F.aggregate(F.slice("lists", F.lit(2), F.size("lists")), F.col("lists")[0], F.array_intersect)
    return full.select(query, "block", both.alias("deltas")).select(query, F.explode(members(width)).alias(member))


def holds_pair(lists: DataFrame, key: str, asked: DataFrame, member: str, width: int = WIDTH) -> DataFrame:
    """The pairs of ``asked`` (key, member) that the lists hold."""
    m = F.col(member).cast("long")
    rows = asked.select(key, member).dropna().distinct().withColumn("block", block_of(m, width))
    return rows.join(lists, [key, "block"]).where(
        F.array_contains("deltas", F.pmod(m, F.lit(width)).cast("int"))).select(key, member)
