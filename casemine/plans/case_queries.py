"""Per-case queries: dimensions, hashes, the given coordinate, template
alignment and the guessed problem / solution lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..operators import cases as CS
from ..operators import guess as G
from ..sources import tables as S
from . import sqlparts as P
from .registry import query


def _sorted_join(c):
    return F.array_join(F.array_sort(c), " ")


@query("case_dimensions", f"""
SELECT d.doc_id AS case_id, coalesce(d.source, {P.q(C.DEFAULT_CUSTOMER)}) AS customer,
       d.lang AS series, d.source AS product,
       CASE WHEN lower({P.PLATFORM}) = {P.q(C.PLATFORM_UNSET)} THEN {P.q(C.PLATFORM_UNKNOWN)}
            ELSE lower({P.PLATFORM}) END AS platform,
       array_to_string(list_sort(list_distinct(string_split(lower(
           coalesce(coalesce(d.lang, '') || '--' || coalesce(d.source, ''), {P.q(C.DEFAULT_CAUSE)})), '--'))),
           ' ') AS cause_words,
       array_to_string(list_sort(list_distinct({P.raw_tokens("string_split(d.text, chr(10))[1]")})), ' ')
           AS title_words,
       coalesce(o.owners, '') AS owners, coalesce(o.n_notes, 0) AS n_notes
FROM documents d LEFT JOIN (
    SELECT conv_id, array_to_string(list_sort(list_distinct(list(role))), ' ') AS owners,
           count(*) AS n_notes
    FROM conversations GROUP BY conv_id) o ON o.conv_id = d.doc_id
""")
def case_dimensions(spark, sf_dir):
    dims = CS.case_dimensions(S.cases(spark, sf_dir), S.notes(spark, sf_dir))
    return dims.select("case_id", "customer", "series", "product", "platform",
                       _sorted_join("cause_words").alias("cause_words"),
                       _sorted_join("title_words").alias("title_words"),
                       _sorted_join("owners").alias("owners"), "n_notes")


@query("case_hashes", f"""
SELECT doc_id AS case_id, md5(cast(doc_id AS VARCHAR)) AS md5,
       {P.md5_mod("cast(doc_id AS VARCHAR)", 100)} AS mod100,
       {P.md5_mod("cast(doc_id AS VARCHAR)", 1000)} AS mod1000,
       {P.md5_mod("cast(doc_id AS VARCHAR)", 10000)} AS mod10000
FROM documents
""")
def case_hashes(spark, sf_dir):
    return CS.case_hashes(S.cases(spark, sf_dir))


_GIVEN_SQL = f"""
SELECT doc_id AS case_id,
       cast({P.md5_mod(f"coalesce({P.PLATFORM}, {P.q(C.DEFAULT_SOFTWARE)})", 10000)} + 1000
            + {P.md5_mod(f"coalesce(source, {P.q(C.DEFAULT_HARDWARE)})", 1000)} + 100
            + {P.md5_mod(f"coalesce(lang, {P.q(C.DEFAULT_HARDWARE)})", 100)} AS DOUBLE) + 1.0 AS x
FROM documents
"""


@query("given_values", _GIVEN_SQL)
def given_values(spark, sf_dir):
    return CS.given_value(S.cases(spark, sf_dir))


@query("given_values_per_note", f"""
SELECT g.case_id, g.x * n.n_notes AS x FROM ({_GIVEN_SQL}) g
JOIN (SELECT conv_id, count(*) AS n_notes FROM conversations GROUP BY conv_id) n
  ON n.conv_id = g.case_id
""")
def given_values_per_note(spark, sf_dir):
    return CS.given_value_per_note(S.cases(spark, sf_dir), S.notes(spark, sf_dir))


@query("problem_template_alignment",
       f"SELECT * FROM {P.alignment_sql('problem', C.PROBLEM_TEMPLATES)} t")
def problem_template_alignment(spark, sf_dir):
    return G.template_alignments(S.cases(spark, sf_dir), "problem")


@query("solution_template_alignment",
       f"SELECT * FROM {P.alignment_sql('solution', C.SOLUTION_TEMPLATES)} t")
def solution_template_alignment(spark, sf_dir):
    return G.template_alignments(S.cases(spark, sf_dir), "solution")


@query("guessed_lines", f"""
SELECT p.case_id, p.line AS problem, p.score AS problem_score,
       s.line AS solution, s.score AS solution_score
FROM {P.guessed_sql('problem', C.PROBLEM_TEMPLATES, C.UNKNOWN_PROBLEM)} p
JOIN {P.guessed_sql('solution', C.SOLUTION_TEMPLATES, C.UNKNOWN_SOLUTION)} s ON s.case_id = p.case_id
""")
def guessed_lines(spark, sf_dir):
    return G.guessed_lines(S.cases(spark, sf_dir))


@query("template_alignment_longest", f"""
SELECT 'problem' AS region, * FROM {P.alignment_sql('problem', C.PROBLEM_TEMPLATES, 'longest', P.COSINE)} p
UNION ALL SELECT 'solution', * FROM {P.alignment_sql('solution', C.SOLUTION_TEMPLATES, 'longest', P.COSINE)} s
""")
def template_alignment_longest(spark, sf_dir):
    """Lines of both regions aligned with the templates by their longest common
    run, with the similarity of the original program and the proper cosine."""
    cases = S.cases(spark, sf_dir)
    parts = [G.template_alignments(cases, region, "longest", cosine=True).select(F.lit(region).alias("region"), "*")
             for region in ("problem", "solution")]
    return parts[0].unionByName(parts[1])


@query("guessed_lines_longest", f"""
SELECT p.case_id, p.line AS problem, p.score AS problem_score,
       s.line AS solution, s.score AS solution_score
FROM {P.guessed_sql('problem', C.PROBLEM_TEMPLATES, C.UNKNOWN_PROBLEM, 'longest')} p
JOIN {P.guessed_sql('solution', C.SOLUTION_TEMPLATES, C.UNKNOWN_SOLUTION, 'longest')} s ON s.case_id = p.case_id
""")
def guessed_lines_longest(spark, sf_dir):
    return G.guessed_lines(S.cases(spark, sf_dir), pick="longest")
