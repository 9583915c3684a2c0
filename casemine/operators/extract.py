"""Relational extract of case notes: a five-way inner equi-join with an
equality filter, an IN list, a prefix match, NULL-as-empty concatenation,
substring deletion and number-to-text casts.

Mapping onto the TPC-H-like tables: note = lineitem, case = orders,
site = customer, owner = nation, condition = region.  The condition table
projects no column, so it is a semi join (an existence filter).

Plan: filters reach the scans; nation and region are broadcast behind a
row-count check (both are fixed-size dimensions); orders x customer and
lineitem x orders are shuffle joins on their keys (co-partitioned by AQE,
skew split when one key is hot).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import PACK_SEPARATOR
from ..functions.text import pack, unpack
from .broadcast import bounded_broadcast

DEFAULT_SEGMENTS = ("AUTOMOBILE", "BUILDING", "MACHINERY")
DEFAULT_CONDITIONS = ("AMERICA", "ASIA", "EUROPE")


def date_prefix_filter(df: DataFrame, c: str, prefix: str):
    """``cast(c as string) LIKE 'prefix%'`` on a date/timestamp column.  A prefix
    of year digits is the same as a year range, which reaches the parquet scan
    as a pushed filter (row groups are skipped by their min/max statistics)."""
    typ = df.schema[c].dataType.simpleString()
    if typ in ("date", "timestamp", "timestamp_ntz") and prefix.isdigit() and len(prefix) <= 4:
        lo = int(prefix.ljust(4, "0"))
        last = int(prefix.ljust(4, "9"))  # years 0999 and 10000 have no such string
        if lo >= 1000:
            cond = F.col(c) >= F.lit(f"{lo:04d}-01-01").cast(typ)
            if last < 9999:
                return cond & (F.col(c) < F.lit(f"{last + 1:04d}-01-01").cast(typ))
            # beyond 9999 the string starts with a sign, so the text decides there
            return cond & F.col(c).cast("string").startswith(prefix)
    return F.col(c).cast("string").startswith(prefix)


def case_notes_extract(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                       nation: DataFrame, region: DataFrame, status: str = "O",
                       segments: Sequence[str] = DEFAULT_SEGMENTS,
                       date_prefix: str = "199", conditions: Sequence[str] = DEFAULT_CONDITIONS,
                       dim_rows: int = 10_000) -> DataFrame:
    o = (orders.where((F.col("o_orderstatus") == status)
                      & date_prefix_filter(orders, "o_orderdate", date_prefix))
         .select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"))
    c = (customer.where(F.col("c_mktsegment").isin(list(segments)))
         .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.where(F.col("r_name").isin(list(conditions))).select(F.col("r_regionkey").alias("n_regionkey"))
    owners = n.join(bounded_broadcast(r, dim_rows), "n_regionkey", "left_semi")
    sites = c.join(bounded_broadcast(owners, dim_rows), c.c_nationkey == owners.n_nationkey, "inner")
    case = o.join(sites, o.o_custkey == sites.c_custkey, "inner")
    li = lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    notes = li.join(case, li.l_orderkey == case.o_orderkey, "inner")
    return notes.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("note_id"),
        F.col("o_orderkey").cast("string").alias("case_id"),
        F.replace(F.col("c_name"), F.lit("Customer#"), F.lit("")).alias("customer"),
        pack("c_mktsegment", "n_name").alias("jhw"),
        F.col("o_orderpriority").alias("jsw"),
        pack("o_orderstatus", "o_orderpriority").alias("numbers"),
        pack("l_returnflag", "l_linestatus").alias("cause"),
        F.col("n_name").alias("owner"),
    )


def case_histories(notes: DataFrame, documents: DataFrame) -> DataFrame:
    """(case_id, history, title = first line) of the extract's cases, once per
    case however many notes it has: the document of the same number."""
    ids = notes.select("case_id").distinct()
    return documents.select(F.col("doc_id").cast("string").alias("case_id"), F.col("text").alias("history"),
                            F.split("text", "\n").getItem(0).alias("title")).join(ids, "case_id", "left_semi")


def case_sets(notes: DataFrame) -> DataFrame:
    """One row per case from note rows (several per case): the sets of its
    customers, series, platforms, cause words and owners as sorted arrays, and
    its number of notes.  Sets are collected per map task first, so a case with
    very many notes sends only its distinct values."""
    words = F.split(F.lower("cause"), PACK_SEPARATOR)
    sets = {"customers": F.col("customer"), "series": unpack("jhw", 1), "platforms": unpack("jhw", 2),
            "owners": F.col("owner")}
    return notes.groupBy("case_id").agg(
        *[F.array_sort(F.collect_set(c)).alias(name) for name, c in sets.items()],
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(words)))).alias("cause_words"),
        F.count(F.lit(1)).alias("notes"))
