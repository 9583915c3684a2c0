"""Guess each case's problem and solution line from its history.

Lines of the leading quarter are scored against the problem templates, lines
from the last quarter on against the solution templates; the best line wins
(ties: the earliest line), or a default text with score 0 when the region is
empty.  All of it is evaluated inside the case row with array functions, so
no shuffle is needed; the templates are a fixed literal list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import template as TP
from ..functions import text as T


def region_lines(history: Column, region: str) -> Column:
    lines = T.history_lines(history)
    return T.leading_slice(lines) if region == "problem" else T.trailing_slice(lines)


def best_line(lines: Column, templates: Sequence[str], default: str, pick: str = "rightmost") -> Column:
    """struct<line, score, line_no> of the best line (line_no 1-based in region).
    ``lines`` should be a plain column (it is referenced twice)."""
    words = F.transform(lines, lambda l, i: F.struct(l.alias("line"), (-i).alias("neg_no"),
                                                      T.line_words(l).alias("words")))
    scored = F.transform(words, lambda r: F.struct(
        TP.line_score(r["words"], templates, pick).alias("score"), r["neg_no"].alias("neg_no"),
        r["line"].alias("line")))
    return F.when(F.size(lines) > 0, F.array_max(scored)).otherwise(
        F.struct(F.lit(0.0).alias("score"), F.lit(1).alias("neg_no"), F.lit(default).alias("line")))


def guessed_lines(cases: DataFrame, problem_templates: Sequence[str] = C.PROBLEM_TEMPLATES,
                  solution_templates: Sequence[str] = C.SOLUTION_TEMPLATES, pick: str = "rightmost") -> DataFrame:
    """case_id, problem, problem_score, solution, solution_score; ``pick``: the
    run that aligns a line with a template ("rightmost" or "longest")."""
    lines = cases.select("case_id", T.history_lines(F.col("history")).alias("lines"))
    regions = lines.select("case_id", T.leading_slice(F.col("lines")).alias("pl"),
                           T.trailing_slice(F.col("lines")).alias("sl"))
    best = regions.select(
        "case_id",
        best_line(F.col("pl"), problem_templates, C.UNKNOWN_PROBLEM, pick).alias("p"),
        best_line(F.col("sl"), solution_templates, C.UNKNOWN_SOLUTION, pick).alias("s"))
    return best.select(
        "case_id", F.col("p.line").alias("problem"), F.col("p.score").alias("problem_score"),
        F.col("s.line").alias("solution"), F.col("s.score").alias("solution_score"))


def template_alignments(cases: DataFrame, region: str = "problem", pick: str = "rightmost",
                        cosine: bool = False) -> DataFrame:
    """Long form: case_id, line_no, template_id, start, run, front, middle,
    tail, score for every aligned (line, template) pair of a region, and the
    ``cosine`` if asked for."""
    templates = C.PROBLEM_TEMPLATES if region == "problem" else C.SOLUTION_TEMPLATES
    lines = T.explode_once(cases, region_lines(F.col("history"), region), "line", "case_id", pos="pos")
    words = lines.select("case_id", (F.col("pos") + 1).alias("line_no"),
                         T.line_words(F.col("line")).alias("words"))
    pairs = T.explode_once(words, TP.line_template_scores(F.col("words"), templates, aligned_only=True, pick=pick,
                                                          cosine=cosine), "a",
                           "case_id", "line_no")
    return pairs.where("a.aligned").select(
        "case_id", "line_no", "a.template_id", "a.start", "a.run", "a.front", "a.middle", "a.tail",
        "a.score", *(["a.cosine"] if cosine else []))
