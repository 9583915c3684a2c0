"""Extract queries (relational part)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import unpack
from ..operators import tokens as TK
from ..operators.extract import case_histories, case_notes_extract, case_sets
from ..sources import tables as S
from . import sqlparts as P
from .registry import query

_EXTRACT_SQL = """
SELECT cast(l.l_orderkey AS VARCHAR) || '-' || cast(l.l_linenumber AS VARCHAR) AS note_id,
       cast(o.o_orderkey AS VARCHAR) AS case_id,
       replace(c.c_name, 'Customer#', '') AS customer,
       coalesce(c.c_mktsegment, '') || '--' || coalesce(n.n_name, '') AS jhw,
       o.o_orderpriority AS jsw,
       coalesce(o.o_orderstatus, '') || '--' || coalesce(o.o_orderpriority, '') AS numbers,
       coalesce(l.l_returnflag, '') || '--' || coalesce(l.l_linestatus, '') AS cause,
       n.n_name AS owner
FROM lineitem l, orders o, customer c, nation n
WHERE o.o_orderstatus = 'O'
  AND c.c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
  AND cast(o.o_orderdate AS VARCHAR) LIKE '199%'
  AND l.l_orderkey = o.o_orderkey AND o.o_custkey = c.c_custkey AND c.c_nationkey = n.n_nationkey
  AND n.n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name IN ('AMERICA', 'ASIA', 'EUROPE'))
"""


def _extract(spark, sf_dir):
    t = lambda n: S.table(spark, sf_dir, n)
    return case_notes_extract(t("lineitem"), t("orders"), t("customer"), t("nation"), t("region"))


@query("case_extract", _EXTRACT_SQL)
def case_extract(spark, sf_dir):
    return _extract(spark, sf_dir)


@query("case_extract_summary", f"""
SELECT owner, count(*) AS notes, count(DISTINCT case_id) AS cases,
       count(DISTINCT customer) AS customers
FROM ({_EXTRACT_SQL}) e GROUP BY owner
""")
def case_extract_summary(spark, sf_dir):
    """Notes, cases and sites per owner over the extract."""
    return _extract(spark, sf_dir).groupBy("owner").agg(
        F.count(F.lit(1)).alias("notes"), F.countDistinct("case_id").alias("cases"),
        F.countDistinct("customer").alias("customers"))


@query("extract_series_platforms", f"""
SELECT split_part(jhw, '--', 1) AS series, split_part(jhw, '--', 2) AS platform,
       count(*) AS notes, count(DISTINCT case_id) AS cases
FROM ({_EXTRACT_SQL}) e GROUP BY ALL
""")
def extract_series_platforms(spark, sf_dir):
    """Notes and cases per (series, platform) unpacked from the packed column."""
    e = _extract(spark, sf_dir)
    return e.select(unpack("jhw", 1).alias("series"), unpack("jhw", 2).alias("platform"), "case_id") \
        .groupBy("series", "platform").agg(F.count(F.lit(1)).alias("notes"),
                                           F.countDistinct("case_id").alias("cases"))


def _set_sql(expr: str) -> str:
    return f"array_to_string(list_sort(list(DISTINCT {expr})), ' ')"


@query("extract_case_sets", f"""
SELECT e.case_id, {_set_sql("customer")} AS customers, {_set_sql("split_part(jhw, '--', 1)")} AS series,
       {_set_sql("split_part(jhw, '--', 2)")} AS platforms, {_set_sql("owner")} AS owners,
       max(c.words) AS cause_words, count(*) AS notes
FROM ({_EXTRACT_SQL}) e JOIN (
    SELECT case_id, {_set_sql("word")} AS words FROM (
        SELECT case_id, unnest(string_split(lower(cause), '--')) AS word FROM ({_EXTRACT_SQL}) x) y
    GROUP BY case_id) c ON c.case_id = e.case_id
GROUP BY e.case_id
""")
def extract_case_sets(spark, sf_dir):
    """Note rows of the extract united per case (set union per dimension)."""
    sets = case_sets(_extract(spark, sf_dir))
    return sets.select("case_id", *[F.array_join(c, " ").alias(c) for c in
                                    ("customers", "series", "platforms", "owners", "cause_words")], "notes")


@query("extract_term_df", f"""
SELECT token AS term, count(*) AS df FROM {P.CLEAN_TOKENS} t
WHERE cast(case_id AS VARCHAR) IN (SELECT case_id FROM ({_EXTRACT_SQL}) e) GROUP BY token
""")
def extract_term_df(spark, sf_dir):
    """The extract feeding the corpus: document frequencies over the histories
    of its cases."""
    cases = case_histories(_extract(spark, sf_dir), S.table(spark, sf_dir, "documents"))
    return TK.term_document_frequency(TK.clean_tokens(cases, S.notes(spark, sf_dir)))
