"""Posting lists: word to cases and back, in blocks, and what is built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import postings as PO
from ..operators import terms as TR
from ..operators.broadcast import join_small
from .model import CaseModel
from .registry import query
from .term_queries import _ITEMS, _TERM_DF, _TOPIC_TOP, _Y

# blocks of the registered queries: narrow, so that the test tables have several a word
WIDTH = 128

_PAIRS = f"(SELECT case_id, unnest(items) AS term FROM {_ITEMS} i)"


def _blocks_sql(pairs: str, key: str, member: str) -> str:
    return f"""
SELECT {key}, {member} // {WIDTH} AS block, count(*) AS n,
       string_agg(CAST({member} % {WIDTH} AS VARCHAR), ' ' ORDER BY {member}) AS deltas
FROM {pairs} p GROUP BY {key}, {member} // {WIDTH}
"""


def _lists(m: CaseModel):
    return PO.blocks(m.item_pairs, "term", "case_id", WIDTH)


def _shown(lists):
    return lists.withColumn("deltas", F.array_join(F.col("deltas").cast("array<string>"), " "))


@query("posting_blocks", _blocks_sql(_PAIRS, "term", "case_id"))
def posting_blocks(spark, sf_dir):
    """The cases of every high-value term, in blocks of neighbouring case ids."""
    return _shown(_lists(CaseModel(spark, sf_dir)))


@query("case_posting_blocks", _blocks_sql(f"""
(SELECT p.case_id, v.term_id FROM {_PAIRS} p JOIN (
   SELECT term, row_number() OVER (ORDER BY df DESC, term) - 1 AS term_id FROM {_TERM_DF} t) v ON v.term = p.term)
""", "case_id", "term_id"))
def case_posting_blocks(spark, sf_dir):
    """The same lists the other way round: the term ids of every case."""
    m = CaseModel(spark, sf_dir)
    return _shown(PO.inverted(_lists(m), "term", "case_id", m.vocabulary, "term_id", WIDTH))


@query("y_from_postings", f"SELECT * FROM {_Y} y")
def y_from_postings(spark, sf_dir):
    """y and its as-coded form from the posting lists: the case's own terms, and
    its frequent ones (as coded: all of them, as the union keeps every word)."""
    m = CaseModel(spark, sf_dir)
    # the items are written for the frequent ones: the lists are made from them too, and
    # as whole cases are dealt by their block, neither lists nor counts are dealt again
    dealt = m.items.repartition(PO.block_of(F.col("case_id").cast("long"), WIDTH))
    lists = PO.blocks(dealt.select("case_id", F.explode("items").alias("term")), "term", "case_id", WIDTH)
    frequent = m.frequent.select(F.col("item").alias("term"), F.lit(1).alias("f")).checkpoint(eager=True)
    flagged = join_small(lists, frequent, "term", "left")
    counts = flagged.select(F.explode(PO.members(WIDTH)).alias("case_id"), F.coalesce("f", F.lit(0)).alias("f")) \
        .groupBy("case_id").agg(F.count(F.lit(1)).alias("n"), F.sum("f").alias("n_freq"))
    n1, n_freq = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)), F.coalesce("n_freq", F.lit(0))
    return m.cases.select("case_id").join(counts, "case_id", "left").select(
        "case_id", (n1 + C.FP_PATTERN_WEIGHT * n_freq).cast("double").alias("y"),
        (n1 * (C.FP_PATTERN_WEIGHT + 1)).cast("double").alias("y_compat"))


# a question per topic: its two best terms of each rank
_ASKED = f"""
(SELECT topic || '-' || CAST((rn - 1) // 2 AS VARCHAR) AS query, term FROM {_TOPIC_TOP} t)
"""


@query("posting_search", f"""
WITH asked AS (SELECT DISTINCT query, term FROM {_ASKED} a),
 wanted AS (SELECT query, count(*) AS wanted FROM asked GROUP BY query)
SELECT query, case_id FROM (
  SELECT asked.query, p.case_id, count(*) AS hits FROM asked JOIN {_PAIRS} p ON p.term = asked.term GROUP BY ALL) h
JOIN wanted USING (query) WHERE hits = wanted
""")
def posting_search(spark, sf_dir):
    """Cases that hold both terms of a question; the questions are the
    neighbouring pairs in the ranking of every topic's terms."""
    m = CaseModel(spark, sf_dir)
    pair = F.expr("(rn - 1) div 2").cast("string")
    asked = m.topic_top.select(F.concat("topic", F.lit("-"), pair).alias("query"), "term")
    # pairs dealt by term: a term has a pair a case at most, and the lists meet the questions where they lie
    lists = PO.blocks(m.item_pairs.repartition("term"), "term", "case_id", WIDTH)
    return PO.holding_all(lists, "term", "case_id", asked, "query", WIDTH)
