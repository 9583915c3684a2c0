"""Corpus: one de-duplicated set of clean tokens per case.

Plan shape: the cleaning chain is one projection over the scan (split,
affix strip, pattern filters and fixed dictionaries as an ``InSet``), the
per-case set is ``array_distinct`` inside the row, so the corpus itself needs
no shuffle.  Only data-derived word lists (case owners, dictionaries read from
files) are applied as anti joins on the long form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from .broadcast import bounded_values, join_small

FIXED_DICTIONARIES = (C.STOP_WORDS, C.DOMAIN_STOP_WORDS, C.NAMES_AND_MONTHS)


def corpus_arrays(cases: DataFrame, dictionaries: Sequence[Sequence[str]] = FIXED_DICTIONARIES,
                  prefixes: Sequence[str] = C.DROP_PREFIXES, keep: Sequence[str] = ()) -> DataFrame:
    """(case_id, *keep, tokens array<string>) with one row per input case row."""
    return cases.select("case_id", *keep, T.clean_token_array("history", dictionaries, prefixes)
                        .alias("tokens"))


def explode_tokens(arrays: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return T.explode_once(arrays, F.col("tokens"), "token", "case_id", *keep)


def drop_words(long: DataFrame, words: DataFrame | None, column: str = "word") -> DataFrame:
    """Anti join the long form against a data-derived word list."""
    if words is None:
        return long
    w = words.select(F.col(column).alias("token")).where(F.col("token").isNotNull()).distinct()
    return join_small(long, w, "token", "left_anti").select(*long.columns)


def owner_words(notes: DataFrame) -> DataFrame:
    """Case owner logins, lower-cased, as a word list (the owner filter)."""
    return notes.select(F.lower("owner").alias("word")).where(F.col("word").isNotNull()).distinct()


def clean_tokens(cases: DataFrame, notes: DataFrame | None = None,
                 extra_words: DataFrame | None = None, keep: Sequence[str] = (),
                 prefixes: Sequence[str] = C.DROP_PREFIXES) -> DataFrame:
    """(case_id, token) pairs, each pair once; ``extra_words`` (word) and
    tokens that start with one of ``prefixes`` are dropped too.

    ``cases`` is keyed by case_id (one row per case); with several rows per
    case (note-level input) use ``clean_tokens_by_case``.
    """
    arrays, rest = clean_arrays(cases, notes, keep, prefixes)
    long = explode_tokens(arrays, keep)
    return drop_words(drop_words(long, rest), extra_words)


def clean_arrays(cases: DataFrame, notes: DataFrame | None = None, keep: Sequence[str] = (),
                 prefixes: Sequence[str] = C.DROP_PREFIXES):
    """(case_id, *keep, tokens) with the owner words removed inside the row
    when the owner list is proven small (checked count); otherwise the owner
    list is returned for an anti join on the long form."""
    dictionaries = list(FIXED_DICTIONARIES)
    rest = None
    if notes is not None:
        owners = owner_words(notes)
        values = bounded_values(owners, "word", 1_000)
        if values is None:
            rest = owners
        else:
            dictionaries.append(values)
    return corpus_arrays(cases, dictionaries, prefixes, keep), rest


def clean_tokens_by_case(note_rows: DataFrame, notes: DataFrame | None = None) -> DataFrame:
    """Same for input with many rows per case: the set union per case is a
    ``distinct`` on the long form (partial aggregation before the shuffle)."""
    return clean_tokens(note_rows, notes).distinct()


def term_document_frequency(tokens: DataFrame) -> DataFrame:
    """(term, df): number of cases that contain the term.  Tokens are a set per
    case, so a plain count is the document frequency; partial aggregation
    keeps hot terms from reaching one reducer in full."""
    return tokens.groupBy(F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("df"))


def token_filter_audit(cases: DataFrame, dictionaries: dict[str, Sequence[str]] | None = None,
                       prefixes: Sequence[str] = C.DROP_PREFIXES) -> DataFrame:
    """(rule, dropped): how many raw tokens each rule matches (rules can overlap),
    plus ``total`` and ``kept`` rows: conditional sums of token counts, the
    rules evaluated once per distinct token."""
    if dictionaries is None:
        dictionaries = {"stop_words": C.STOP_WORDS, "domain_stop_words": C.DOMAIN_STOP_WORDS,
                        "names": C.NAMES_AND_MONTHS}
    raw = T.explode_once(cases, F.transform(
        T.raw_tokens(T.null_default("history", C.DEFAULT_HISTORY)), T.strip_affixes), "w")
    # rules are evaluated once per distinct token, weighted by its count
    distinct = raw.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    w = F.col("w")
    flags = T.token_rule_flags(w, prefixes)
    for name, words in dictionaries.items():
        flags[name] = w.isin(sorted(set(words)))
    kept = T.token_is_kept(w, dictionaries.values(), prefixes)
    n = F.col("n")
    aggs = [F.sum(F.when(f, n).otherwise(0)).alias(k) for k, f in flags.items()]
    aggs += [F.sum(n).alias("total"), F.sum(F.when(kept, n).otherwise(0)).alias("kept")]
    wide = distinct.agg(*aggs)
    names = list(flags) + ["total", "kept"]
    stack = "stack({}, {}) as (rule, dropped)".format(
        len(names), ", ".join(f"'{n}', `{n}`" for n in names))
    return wide.selectExpr(stack).select("rule", F.col("dropped").cast("long"))
