"""Multinomial naive Bayes on case term sets, in closed form with DataFrame
aggregations (the same estimates as Spark ML's NaiveBayes with
``smoothing=lambda`` on binary term vectors):

    prior_c   = ln(N_c + lambda) - ln(N + C * lambda)
    theta_c,w = ln(n_c,w + lambda) - ln(n_c + V * lambda)

N_c: training cases of class c, n_c,w: cases of class c containing w,
n_c = sum_w n_c,w, V: vocabulary size, C: number of classes.  Only observed
(class, term) pairs are stored; an unseen pair has ln(lambda) - ln(n_c + V lambda).
Scoring pivots the bounded class list into one row per term, joins a case's terms
with it (the most frequent ones by broadcast, the others by a shuffle on term)
and aggregates once per case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import ensure_checkpoint_dir
from .broadcast import bounded_broadcast


def fit(tokens: DataFrame, labels: DataFrame, vocab_size: int, smoothing: float = C.NB_SMOOTHING):
    """tokens (case_id, token), labels (case_id, label).  Returns
    (classes: label, docs, n_terms, prior, log_unseen, denom;
     term_log_probs: label, term, log_prob)."""
    return fit_pairs(tokens.join(labels.select("case_id", "label"), "case_id", "inner"), labels, vocab_size, smoothing)


def fit_pairs(pairs: DataFrame, labels: DataFrame, vocab_size: int, smoothing: float = C.NB_SMOOTHING):
    """The same from the tokens with their case's label (label, token).  Counted
    once: the counts are checkpointed, as both tables are made from them."""
    ensure_checkpoint_dir(pairs.sparkSession)
    docs = labels.select("case_id", "label").groupBy("label").agg(F.count(F.lit(1)).alias("docs"))
    ncw = pairs.groupBy("label", F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("n_cw")).checkpoint(eager=True)
    nc = ncw.groupBy("label").agg(F.sum("n_cw").alias("n_terms"))
    # two numbers over the (bounded) class table
    t = docs.agg(F.sum("docs").alias("n"), F.count(F.lit(1)).alias("c")).first()
    lam = F.lit(float(smoothing))
    classes = docs.join(nc, "label", "left").select(
        "label", "docs", F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        (F.log(F.col("docs") + lam) - F.log(F.lit(float(t["n"])) + F.lit(float(t["c"])) * lam))
        .alias("prior"),
        (F.coalesce("n_terms", F.lit(0)) + F.lit(vocab_size) * lam).alias("denom"))
    classes = classes.withColumn("log_unseen", F.log(lam) - F.log("denom"))
    probs = ncw.join(bounded_broadcast(classes.select("label", "denom"), 100_000), "label").select(
        "label", "term", (F.log(F.col("n_cw") + lam) - F.log("denom")).alias("log_prob"))
    return classes, probs


MAX_CLASSES = 10_000  # classes become columns of the pivoted model


def class_list(classes: DataFrame) -> list:
    """The class labels in order, after a check that they are few."""
    if classes.count() > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return [r["label"] for r in classes.select("label").orderBy("label").collect()]


NEAR_TERMS, NEAR_CELLS, NEAR_BYTES = 100_000, 2_000_000, 16 << 20


def frequent_terms(counts: DataFrame, n: str, most: int, most_bytes: int = NEAR_BYTES) -> tuple[DataFrame, bool]:
    """The terms (token) of ``counts`` with the largest counts, as many counts as
    keep within ``most`` terms and so many bytes, and whether these are all.
    To the driver comes a row for each different count."""
    sizes = counts.groupBy(n).agg(F.count(F.lit(1)).alias("terms"), F.sum(F.octet_length("token")).alias("bytes"))
    least, terms, size = None, 0, 0
    found = sorted(((r[n], r["terms"], r["bytes"] or 0) for r in sizes.collect()), reverse=True)
    for count, more, more_bytes in found:
        terms, size = terms + more, size + more_bytes
        if terms > most or size > most_bytes:
            break
        least = count
    chosen = counts.where(F.lit(False) if least is None else F.col(n) >= least).select("token")
    return chosen, not found or least == found[-1][0]


def predict_cases(tokens: DataFrame, classes: DataFrame, probs: DataFrame, class_values: list,
                  cases: DataFrame | None = None, term_counts: DataFrame | None = None) -> DataFrame:
    """(case_id, prediction); ties go to the smaller label.  Cases of ``cases``
    (case_id) without any token get the class of the largest prior.
    ``term_counts`` (term, df): the tokens counted, if they are already.

    The classes are a bounded list, so the model is pivoted to one row per
    term with one gain column per class (log_prob - log_unseen).  The gains of
    the tokens' most frequent terms, a bounded number, are broadcast and summed up
    where the case lies; only the other tokens are shuffled, by term, and only
    they bring a case's sums from several tasks.  The per-class scores and the
    arg-max are evaluated inside the row.
    """
    pri = {r["label"]: (r["prior"], r["log_unseen"]) for r in
           classes.select("label", "prior", "log_unseen").collect()}
    unseen = {c: pri[c][1] for c in class_values}

    def gains(of: DataFrame) -> DataFrame:
        wide = of.repartition("term").groupBy("term").pivot("label", class_values).agg(F.first("log_prob"))
        return wide.select(F.col("term").alias("token"), *[
            (F.col(f"`{c}`") - F.lit(unseen[c])).alias(f"g{i}") for i, c in enumerate(class_values)])

    ensure_checkpoint_dir(tokens.sparkSession)
    if term_counts is None:
        counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).checkpoint(eager=True)
    else:
        counts = term_counts.select(F.col("term").alias("token"), "df")
    near, all_near = frequent_terms(counts.where(F.col("token").isNotNull()), "df",
                                    min(NEAR_TERMS, NEAR_CELLS // max(1, len(class_values))))
    near = F.broadcast(near)
    of_near = gains(probs.join(near.withColumnRenamed("token", "term"), "term", "left_semi"))
    joined = tokens.join(F.broadcast(near.join(of_near, "token", "left")), "token")
    far = tokens.where(F.col("token").isNull()) if all_near else tokens.join(near, "token", "left_anti")
    of_far = gains(probs.join(near.withColumnRenamed("token", "term"), "term", "left_anti"))
    joined = joined.unionByName(far.join(of_far, "token", "left"))
    per_case = joined.groupBy("case_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.coalesce(f"g{i}", F.lit(0.0))).alias(f"s{i}") for i in range(len(class_values))])
    if cases is not None:
        per_case = cases.select("case_id").distinct().join(per_case, "case_id", "left").na.fill(
            0, ["n"]).na.fill(0.0, [f"s{i}" for i in range(len(class_values))])
    scores = F.array(*[F.struct(
        (F.lit(pri[c][0]) + F.col("n") * F.lit(unseen[c]) + F.col(f"s{i}")).alias("score"),
        F.lit(-c).alias("neg")) for i, c in enumerate(class_values)])
    return per_case.select("case_id", (-F.array_max(scores)["neg"]).alias("prediction"))


def accuracy(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """share of cases whose prediction equals the label."""
    j = predictions.join(labels.select("case_id", "label"), "case_id", "inner")
    return j.agg(F.round(F.avg(F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0)), 9)
                 .alias("accuracy"), F.count(F.lit(1)).alias("cases"))
