"""Term queries: vocabulary, weights, topic top terms, transactions, frequent
items and the y coordinate."""

from __future__ import annotations

from .. import config as C
from ..operators import terms as TR
from ..operators import tokens as TK
from ..sources import tables as S
from . import sqlparts as P
from .model import CaseModel
from .registry import query

_TERM_DF = f"(SELECT token AS term, count(*) AS df FROM {P.CLEAN_TOKENS} t GROUP BY token)"


def _corpus(spark, sf_dir, keep=()):
    return TK.clean_tokens(S.cases(spark, sf_dir), S.notes(spark, sf_dir), keep=keep)


def _term_df(spark, sf_dir):
    return TK.term_document_frequency(_corpus(spark, sf_dir))


@query("vocabulary", f"""
SELECT term, row_number() OVER (ORDER BY df DESC, term) - 1 AS term_id, df FROM {_TERM_DF} v
""")
def vocabulary(spark, sf_dir):
    return TR.vocabulary(_term_df(spark, sf_dir))


@query("vocabulary_stats", f"""
SELECT count(*) AS vocab_size, sum(df)::BIGINT AS total_tokens,
       CAST({float(C.LDA_ALPHA_NUMERATOR // C.LDA_TOPICS)} AS DOUBLE) AS alpha,
       round({float(C.LDA_BETA_NUMERATOR)} / count(*) + 1, 9) AS beta
FROM {_TERM_DF} v
""")
def vocabulary_stats(spark, sf_dir):
    return TR.vocabulary_stats(_term_df(spark, sf_dir))



_GUESSED = f"""
(SELECT p.case_id, p.line AS problem, p.score AS problem_score,
        s.line AS solution, s.score AS solution_score
 FROM {P.guessed_sql('problem', C.PROBLEM_TEMPLATES, C.UNKNOWN_PROBLEM)} p
 JOIN {P.guessed_sql('solution', C.SOLUTION_TEMPLATES, C.UNKNOWN_SOLUTION)} s ON s.case_id = p.case_id)
"""


# the weight of every term, by how terms are found in the guessed lines
_WEIGHTS = f"""
WITH facts AS (
  SELECT term, 'v' AS kind, 0.0 AS val FROM {_TERM_DF} v
  UNION ALL SELECT unnest(list_distinct({P.raw_tokens("string_split(text, chr(10))[1]")})), 'title', 0.0
            FROM documents
  UNION ALL SELECT unnest(list_distinct(string_split(lower(coalesce(lang, '') || '--' ||
            coalesce(source, '')), '--'))), 'cause', 0.0 FROM documents
  UNION ALL {{in_problem}}
  UNION ALL {{in_solution}}
), folded AS (
  SELECT term, max(CASE WHEN kind = 'v' THEN 1 END) AS is_v,
         max(CASE WHEN kind = 'title' THEN 1 END) AS is_title,
         max(CASE WHEN kind = 'cause' THEN 1 END) AS is_cause,
         max(CASE WHEN kind = 'problem' THEN val END) AS p_score,
         max(CASE WHEN kind = 'solution' THEN val END) AS s_score
  FROM facts GROUP BY term)
SELECT term, round(1.0
   + CASE WHEN length(term) > {C.LONG_WORD_LENGTH} THEN {P.md5_mod('term', 100)} + 10 ELSE 0 END
   + CASE WHEN is_cause = 1 THEN {P.md5_mod('term', 1000)} + 100 ELSE 0 END
   + CASE WHEN is_title = 1 THEN {P.md5_mod('term', 10000)} + 1000 ELSE 0 END
   + coalesce(p_score % 10000 + 1000, 0.0)
   + coalesce(s_score % 10000 + 1000, 0.0), 6) AS weight
FROM folded WHERE is_v = 1
"""

_TOKEN_MATCH = {kind: f"SELECT unnest({P.line_terms(kind)}), '{kind}', {kind}_score FROM {_GUESSED} g"
                for kind in ("problem", "solution")}
_SUBSTRING_MATCH = {kind: f"SELECT v.term, '{kind}', g.{kind}_score FROM {_TERM_DF} v, {_GUESSED} g "
                          f"WHERE contains(g.{kind}, v.term)" for kind in ("problem", "solution")}


def _weights_sql(match: dict[str, str]) -> str:
    return _WEIGHTS.replace("{in_problem}", match["problem"]).replace("{in_solution}", match["solution"])


@query("term_weights", _weights_sql(_TOKEN_MATCH))
def term_weights(spark, sf_dir):
    return CaseModel(spark, sf_dir).weights


@query("term_weights_substring", _weights_sql(_SUBSTRING_MATCH))
def term_weights_substring(spark, sf_dir):
    """The same with terms found anywhere inside the guessed lines."""
    return CaseModel(spark, sf_dir, match="substring").weights


_TOPIC_TOP = f"""
(WITH s AS (SELECT series AS topic, token AS term, count(*)::DOUBLE AS score
            FROM {P.CLEAN_TOKENS_S} t GROUP BY series, token),
 f AS (SELECT * FROM s WHERE length(term) >= {C.TOPIC_MIN_TERM_LENGTH}),
 r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, term) AS rn,
              count(*) OVER (PARTITION BY topic) AS n FROM f)
 SELECT topic, term, score, rn FROM r WHERE rn <= floor(n * {C.TOPIC_TOP_FRACTION}))
"""


@query("topic_top_terms", f"SELECT * FROM {_TOPIC_TOP} tt")
def topic_top_terms(spark, sf_dir):
    return CaseModel(spark, sf_dir).topic_top


@query("high_value_terms", f"SELECT DISTINCT term FROM {_TOPIC_TOP} tt")
def high_value_terms(spark, sf_dir):
    return CaseModel(spark, sf_dir).hv_terms



_ITEMS = f"""
(SELECT d.doc_id AS case_id, coalesce(i.items, []::VARCHAR[]) AS items,
        len(coalesce(i.items, []::VARCHAR[])) AS n_items
 FROM documents d LEFT JOIN (
   SELECT case_id, list_sort(list(token)) AS items FROM {P.CLEAN_TOKENS} t
   WHERE token IN (SELECT term FROM {_TOPIC_TOP} tt) GROUP BY case_id) i ON i.case_id = d.doc_id)
"""


@query("case_items", f"SELECT case_id, array_to_string(items, ' ') AS items, n_items FROM {_ITEMS} it")
def case_items(spark, sf_dir):
    return CaseModel(spark, sf_dir).items_text()


_FREQUENT = f"""
(SELECT item, count(*) AS support FROM (SELECT unnest(items) AS item FROM {_ITEMS} it) u
 GROUP BY item HAVING count(*) >= ceil({C.FP_MIN_SUPPORT} * (SELECT count(*) FROM documents)))
"""


@query("frequent_items", f"SELECT * FROM {_FREQUENT} fi")
def frequent_items(spark, sf_dir):
    return CaseModel(spark, sf_dir).frequent


_Y = f"""
(SELECT it.case_id,
        CAST(greatest(it.n_items, 1) + {C.FP_PATTERN_WEIGHT} * coalesce(nf.n_freq, 0) AS DOUBLE) AS y,
        CAST(greatest(it.n_items, 1) * {C.FP_PATTERN_WEIGHT + 1} AS DOUBLE) AS y_compat
 FROM {_ITEMS} it LEFT JOIN (
   SELECT case_id, count(*) AS n_freq FROM (SELECT case_id, unnest(items) AS item FROM {_ITEMS} i2) u
   WHERE item IN (SELECT item FROM {_FREQUENT} f) GROUP BY case_id) nf ON nf.case_id = it.case_id)
"""


@query("y_values", f"SELECT * FROM {_Y} y")
def y_values(spark, sf_dir):
    return CaseModel(spark, sf_dir).y
