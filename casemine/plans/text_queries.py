"""Corpus queries: clean tokens, document frequency, filter audit, word count."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import config as C
from ..operators import tokens as TK
from ..operators import wordcount as WC
from ..session import scratch_path
from ..sources import tables as S
from ..sources.dictionary import read_word_list
from . import sqlparts as P
from .registry import query


def corpus(spark, sf_dir):
    return TK.clean_tokens(S.cases(spark, sf_dir), S.notes(spark, sf_dir))


@query("clean_tokens", f"SELECT case_id, token FROM {P.CLEAN_TOKENS} t")
def clean_tokens(spark, sf_dir):
    return corpus(spark, sf_dir)


@query("corpus_term_df", f"""
SELECT token AS term, count(*) AS df FROM {P.CLEAN_TOKENS} t GROUP BY token
""")
def corpus_term_df(spark, sf_dir):
    return TK.term_document_frequency(corpus(spark, sf_dir))


@query("top_terms", f"""
SELECT token AS term, count(*) AS df FROM {P.CLEAN_TOKENS} t
GROUP BY token ORDER BY df DESC, term LIMIT 100
""")
def top_terms(spark, sf_dir):
    """Top-100 report of the corpus (the limit is the feature)."""
    return corpus_term_df(spark, sf_dir).orderBy(F.desc("df"), "term").limit(100)


def _audit_sql() -> str:
    w = "w"
    flags = P.rule_flags(w)
    flags["stop_words"] = f"{w} IN {P.in_list(C.STOP_WORDS)}"
    flags["domain_stop_words"] = f"{w} IN {P.in_list(C.DOMAIN_STOP_WORDS)}"
    flags["names"] = f"{w} IN {P.in_list(C.NAMES_AND_MONTHS)}"
    parts = [f"SELECT {P.q(n)} AS rule, sum(CASE WHEN {f} THEN 1 ELSE 0 END)::BIGINT AS dropped FROM raw"
             for n, f in flags.items()]
    parts.append("SELECT 'total' AS rule, count(*)::BIGINT AS dropped FROM raw")
    parts.append(f"SELECT 'kept' AS rule, sum(CASE WHEN {P.keep_predicate(w)} THEN 1 ELSE 0 END)::BIGINT"
                 " AS dropped FROM raw")
    raw = (f"raw AS (SELECT {P.strip('t')} AS w FROM (SELECT unnest("
           f"{P.raw_tokens('coalesce(text, ' + P.q(C.DEFAULT_HISTORY) + ')')}) AS t FROM documents) r)")
    return f"WITH {raw} " + " UNION ALL ".join(parts)


@query("token_filter_audit", _audit_sql())
def token_filter_audit(spark, sf_dir):
    return TK.token_filter_audit(S.cases(spark, sf_dir))


@query("note_word_count", """
SELECT word, sum(1)::DOUBLE AS total
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) w
GROUP BY word
""")
def note_word_count(spark, sf_dir):
    """Word count of the note texts (map: words of a line, reduce: sum)."""
    return WC.word_count(S.notes(spark, sf_dir), "text")


_NOTE_TOKENS = f"""
(SELECT DISTINCT case_id, token FROM (
   SELECT conv_id AS case_id, {P.strip('w')} AS token
   FROM (SELECT conv_id, unnest({P.raw_tokens("coalesce(text, " + P.q(C.DEFAULT_HISTORY) + ")")}) AS w
         FROM conversations) r) s
 WHERE {P.keep_predicate('token')}
   AND token NOT IN (SELECT word FROM {P.OWNER_WORDS} o))
"""


@query("note_corpus_term_df", f"""
SELECT token AS term, count(*) AS df FROM {_NOTE_TOKENS} t GROUP BY token
""")
def note_corpus_term_df(spark, sf_dir):
    """Document frequency over the note log: every note row is cleaned, the
    token sets of all notes of a case are united per case, then counted."""
    notes = S.notes(spark, sf_dir)
    rows = S.spread(notes).select("case_id", F.col("text").alias("history"))
    return TK.term_document_frequency(TK.clean_tokens_by_case(rows, notes))


_MORE_PREFIXES = ["re", "un"]


@query("clean_tokens_more_filters", f"""
SELECT case_id, token FROM {P.CLEAN_TOKENS} t
WHERE NOT (starts_with(token, 're') OR starts_with(token, 'un'))
  AND token NOT IN (SELECT DISTINCT trim(unnest(string_split(lower(text), chr(10)))) FROM benchmark)
  AND token NOT IN (SELECT DISTINCT unnest(string_split(lower(text), ' ')) FROM benchmark)
""")
def clean_tokens_more_filters(spark, sf_dir):
    """Clean tokens without those of a dictionary file (one word per line,
    written from the benchmark's words) and of two more prefixes."""
    path = scratch_path(spark, f"dictionary-{uuid.uuid4().hex}")
    lines = S.table(spark, sf_dir, "benchmark").select(F.explode(F.flatten(F.array(
        F.split("text", "\n"), F.split("text", " ")))).alias("value"))
    lines.where(~F.col("value").contains("\n")).write.text(path)
    return TK.clean_tokens(S.cases(spark, sf_dir), S.notes(spark, sf_dir), read_word_list(spark, path),
                           prefixes=[*C.DROP_PREFIXES, *_MORE_PREFIXES])
