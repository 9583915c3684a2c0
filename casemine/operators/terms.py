"""Vocabulary, term weights, topic top terms and case transactions.

Shuffles: the vocabulary is one partial/final aggregation of the corpus;
all per-term facts (title word, cause word, guessed line word) are unioned
into one long table and folded by a single ``groupBy(term)``; hot terms are
combined map-side before the exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from ..functions.hashing import md5_mod
from .broadcast import bounded_values, join_small
from .ranking import row_number_within
from .substring import contained_scores


def vocabulary(term_df: DataFrame) -> DataFrame:
    """(term, term_id, df): dense 0-based index by df descending, then term."""
    ranked = row_number_within(term_df, [], [F.col("df").desc(), F.col("term").asc()])
    return ranked.select("term", (F.col("rn") - 1).alias("term_id"), "df")


def vocabulary_stats(term_df: DataFrame, k: int = C.LDA_TOPICS) -> DataFrame:
    """vocab_size, total_tokens and the LDA priors alpha = 50 div k,
    beta = 200 / |V| + 1."""
    s = term_df.agg(F.count(F.lit(1)).alias("vocab_size"), F.sum("df").alias("total_tokens"))
    return s.select("vocab_size", F.col("total_tokens").cast("long").alias("total_tokens"),
                    F.lit(float(C.LDA_ALPHA_NUMERATOR // k)).alias("alpha"),
                    F.round(F.lit(float(C.LDA_BETA_NUMERATOR)) / F.col("vocab_size") + 1, 9)
                    .alias("beta"))


def line_terms(line) -> F.Column:
    """Terms of a guessed line, prepared like corpus tokens (no filters)."""
    return F.array_distinct(F.transform(T.raw_tokens(line), T.strip_affixes))


def term_weights(term_df: DataFrame, dims: DataFrame, guessed: DataFrame, match: str = "token") -> DataFrame:
    """(term, weight) for every vocabulary term:
    min(count, 9) [count is 1: tokens are a set per case]
    + (md5 % 100 + 10 when longer than 7 characters)
    + (md5 % 1000 + 100 when a cause word) + (md5 % 10000 + 1000 when a title word)
    + (best score % 10000 + 1000 when in a guessed problem line) + (same for solution).
    match: "token" (a term is in a line when it is one of its words) or
    "substring" (when it occurs anywhere in the line).
    """
    if match == "substring":
        term_df = term_df.checkpoint(eager=True)  # read several times
        lines = [guessed.select(F.lit(kind).alias("kind"), F.col(kind).alias("line"), F.col(f"{kind}_score").alias("score"))
                 for kind in ("problem", "solution")]
        in_lines = [contained_scores(term_df, lines[0].unionByName(lines[1])).withColumnRenamed("score", "val")]
    else:
        in_lines = [guessed.select(F.explode(line_terms(F.col(kind))).alias("term"), F.lit(kind).alias("kind"),
                                   F.col(f"{kind}_score").alias("val")) for kind in ("problem", "solution")]
    facts = [
        term_df.select("term", F.lit("v").alias("kind"), F.lit(0.0).alias("val")),
        dims.select(F.explode("title_words").alias("term"), F.lit("title").alias("kind"),
                    F.lit(0.0).alias("val")),
        dims.select(F.explode("cause_words").alias("term"), F.lit("cause").alias("kind"),
                    F.lit(0.0).alias("val")),
        *in_lines,
    ]
    allf = facts[0]
    for f in facts[1:]:
        allf = allf.unionByName(f)
    k = F.col("kind")
    folded = allf.groupBy("term").agg(
        F.max(F.when(k == "v", 1)).alias("is_v"),
        F.max(F.when(k == "title", 1)).alias("is_title"),
        F.max(F.when(k == "cause", 1)).alias("is_cause"),
        F.max(F.when(k == "problem", F.col("val"))).alias("p_score"),
        F.max(F.when(k == "solution", F.col("val"))).alias("s_score"),
    ).where("is_v = 1")
    t = F.col("term")
    weight = (F.lit(float(min(1, C.WEIGHT_COUNT_CAP)))
              + F.when(F.length(t) > C.LONG_WORD_LENGTH, md5_mod(t, 100) + 10).otherwise(0)
              + F.when(F.col("is_cause") == 1, md5_mod(t, 1000) + 100).otherwise(0)
              + F.when(F.col("is_title") == 1, md5_mod(t, 10000) + 1000).otherwise(0)
              + F.coalesce(F.col("p_score") % 10000 + 1000, F.lit(0.0))
              + F.coalesce(F.col("s_score") % 10000 + 1000, F.lit(0.0)))
    return folded.select("term", F.round(weight, 6).alias("weight"))


def series_topic_scores(tokens_with_series: DataFrame) -> DataFrame:
    """(topic, term, score): a deterministic topic model where each product
    series is a topic and a term's score is its document frequency in it."""
    return tokens_with_series.groupBy(F.col("series").alias("topic"), F.col("token").alias("term")) \
        .agg(F.count(F.lit(1)).cast("double").alias("score"))


def topic_top_terms(scores: DataFrame, fraction: float = C.TOPIC_TOP_FRACTION,
                    min_len: int = C.TOPIC_MIN_TERM_LENGTH) -> DataFrame:
    """Best floor(n * fraction) terms of each topic by score (ties: term),
    counting only terms of at least ``min_len`` characters."""
    s = scores.where(F.length("term") >= min_len)
    ranked = row_number_within(s, ["topic"], [F.col("score").desc(), F.col("term").asc()],
                               size_name="n_terms")
    return ranked.where(F.col("rn") <= F.floor(F.col("n_terms") * fraction)) \
        .select("topic", "term", "score", "rn")


def high_value_terms(top: DataFrame) -> DataFrame:
    return top.select("term").distinct()


BROADCAST_TERMS = 1_000_000


def best_terms(top: DataFrame, n: int) -> DataFrame:
    """(term): the best terms of every topic (``top``: topic, term, rn), as many
    of each, ``n`` together at most."""
    each = n // max(1, top.select("topic").distinct().count())
    return top.where(F.col("rn") <= each).select("term").distinct()


def item_pairs(tokens: DataFrame, hv_terms: DataFrame, top: DataFrame | None = None) -> DataFrame:
    """(case_id, term): the high-value terms of the cases, as pairs.  Where the
    terms are too many to be broadcast, the best of ``top`` are, which most
    tokens are: only the other tokens are shuffled."""
    best = None if top is None else best_terms(top, BROADCAST_TERMS).withColumnRenamed("term", "token")
    hv = join_small(tokens, hv_terms.withColumnRenamed("term", "token"), "token", "left_semi",
                    BROADCAST_TERMS, best)
    return hv.select("case_id", F.col("token").alias("term"))


def case_items(tokens: DataFrame, hv_terms: DataFrame, cases: DataFrame, top: DataFrame | None = None) -> DataFrame:
    """(case_id, items array<string>, n_items): the case's high-value terms;
    every case has a row (empty array when it has none)."""
    per_case = item_pairs(tokens, hv_terms, top).groupBy("case_id").agg(F.array_sort(F.collect_list("term")).alias("items"))
    return cases.select("case_id").join(per_case, "case_id", "left").select(
        "case_id", F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.size(F.coalesce("items", F.array().cast("array<string>"))).alias("n_items"))


def frequent_items(items: DataFrame, min_support: float = C.FP_MIN_SUPPORT) -> DataFrame:
    """(item, support): single items in at least ceil(min_support * N)
    transactions, N counting empty transactions too (as FP-growth does).
    Every item of a frequent itemset is itself a frequent single item, so this
    is also the set of words inside the frequent itemsets."""
    min_count = math.ceil(min_support * items.count())
    counts = items.select(F.explode("items").alias("item")).groupBy("item") \
        .agg(F.count(F.lit(1)).alias("support"))
    return counts.where(F.col("support") >= F.lit(min_count))


def y_values(items: DataFrame, frequent: DataFrame) -> DataFrame:
    """(case_id, y, y_compat): y = max(n, 1) + 100 * (frequent items of the
    case); y_compat = 101 * max(n, 1), what the original union yields.
    The frequent items number at most items/(support * N) = 4 x the mean
    transaction length; when a checked count proves them small they are
    intersected inside the row (no shuffle), else joined."""
    n1 = F.greatest(F.col("n_items"), F.lit(1))
    compat = (n1 * F.lit(C.FP_PATTERN_WEIGHT + 1)).cast("double").alias("y_compat")
    values = bounded_values(frequent, "item", 1_000)
    if values is not None:
        freq = F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")
        n_freq = F.size(F.array_intersect("items", freq))
        return items.select("case_id", (n1 + F.lit(C.FP_PATTERN_WEIGHT) * n_freq).cast("double").alias("y"),
                            compat)
    pairs = items.select("case_id", F.explode("items").alias("item"))
    flagged = pairs.join(frequent.select("item", F.lit(1).alias("f")), "item", "left")
    nf = flagged.groupBy("case_id").agg(F.sum(F.coalesce("f", F.lit(0))).alias("n_freq"))
    return items.join(nf, "case_id", "left").select(
        "case_id",
        (n1 + F.lit(C.FP_PATTERN_WEIGHT) * F.coalesce("n_freq", F.lit(0))).cast("double").alias("y"),
        compat)
