"""Model queries: naive Bayes (closed form, SQL-checked), FP-growth itemsets,
LDA topics and k-means clusters (seeded; what they must satisfy by definition
is checked by companion queries)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from .. import config as C
from ..operators import classify as NB
from ..operators import cluster as CL
from ..operators import mining as MN
from ..operators import tokens as TK
from ..session import scratch_path
from ..sources import tables as S
from ..sources.streams import file_stream
from ..streaming import scoring as SC
from ..streaming.models import ModelVersions
from . import sqlparts as P
from .model import CaseModel
from .registry import query
from .cluster_queries import _ASSIGNED, K
from .term_queries import _ITEMS, _TERM_DF, _TOKEN_MATCH, _weights_sql


def _nb(spark, sf_dir):
    m = CaseModel(spark, sf_dir)
    labels = S.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("case_id"),
                                                      F.col("quality").alias("label"))
    classes, probs = NB.fit(m.corpus, labels, m.term_df.count())
    return m, labels, classes.checkpoint(eager=True), probs.checkpoint(eager=True)


_NB_OF = f"""
WITH tok AS {P.CLEAN_TOKENS},
 v AS (SELECT count(DISTINCT token) AS vsize FROM tok),
 lab AS (LABELS),
 docs AS (SELECT label, count(*) AS docs FROM lab GROUP BY label),
 tot AS (SELECT sum(docs) AS n, count(*) AS c FROM docs),
 ncw AS (SELECT label, token AS term, count(*) AS n_cw FROM tok JOIN lab USING (case_id) GROUP BY ALL),
 nc AS (SELECT label, sum(n_cw) AS n_terms FROM ncw GROUP BY label),
 classes AS (SELECT d.label, d.docs, coalesce(nc.n_terms, 0) AS n_terms,
                    ln(d.docs + {C.NB_SMOOTHING}) - ln(tot.n + tot.c * {C.NB_SMOOTHING}) AS prior,
                    coalesce(nc.n_terms, 0) + v.vsize * {C.NB_SMOOTHING} AS denom
             FROM docs d LEFT JOIN nc USING (label), tot, v),
 probs AS (SELECT ncw.label, term, ln(n_cw + {C.NB_SMOOTHING}) - ln(denom) AS log_prob
           FROM ncw JOIN classes USING (label))
"""
_NB = _NB_OF.replace("LABELS", "SELECT doc_id AS case_id, quality AS label FROM labels")


@query("nb_class_priors", _NB + """
SELECT label, docs, n_terms, round(prior, 9) AS prior,
       round(ln(1.0) - ln(denom), 9) AS log_unseen FROM classes
""")
def nb_class_priors(spark, sf_dir):
    _, _, classes, _ = _nb(spark, sf_dir)
    return classes.select("label", "docs", F.col("n_terms").cast("long").alias("n_terms"),
                          F.round("prior", 9).alias("prior"), F.round("log_unseen", 9).alias("log_unseen"))


@query("nb_term_log_probs", _NB + "SELECT label, term, round(log_prob, 9) AS log_prob FROM probs")
def nb_term_log_probs(spark, sf_dir):
    _, _, _, probs = _nb(spark, sf_dir)
    return probs.select("label", "term", F.round("log_prob", 9).alias("log_prob"))


_PREDICT = """,
 ntok AS (SELECT d.doc_id AS case_id, count(tok.token) AS n
          FROM documents d LEFT JOIN tok ON tok.case_id = d.doc_id GROUP BY d.doc_id),
 base AS (SELECT case_id, label, prior + n * (ln(1.0) - ln(denom)) AS base, ln(1.0) - ln(denom) AS lu
          FROM ntok, classes),
 seen AS (SELECT case_id, label, sum(log_prob) AS s_seen, count(*) AS k_seen
          FROM tok JOIN probs ON probs.term = tok.token GROUP BY ALL),
 scored AS (SELECT b.case_id, b.label, b.base + coalesce(s.s_seen, 0) - coalesce(s.k_seen, 0) * b.lu AS score
            FROM base b LEFT JOIN seen s USING (case_id, label)),
 pred AS (SELECT case_id, label AS prediction FROM (
            SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY score DESC, label) AS k FROM scored) z
          WHERE k = 1)
"""
_NB_PRED = _NB + _PREDICT


@query("nb_accuracy", _NB_PRED + """
SELECT round(avg(CASE WHEN p.prediction = l.label THEN 1.0 ELSE 0.0 END), 9) AS accuracy,
       count(*) AS cases
FROM pred p JOIN lab l USING (case_id)
""")
def nb_accuracy(spark, sf_dir):
    m, labels, classes, probs = _nb(spark, sf_dir)
    pred = NB.predict_cases(m.corpus, classes, probs, NB.class_list(classes), m.cases, m.term_df)
    return NB.accuracy(pred, labels)


_FP_SQL = f"""
WITH RECURSIVE t AS (SELECT case_id, items FROM {_ITEMS} it),
 f1 AS (SELECT item, count(*) AS support FROM (SELECT unnest(items) AS item FROM t) u GROUP BY item
        HAVING count(*) >= ceil({C.FP_SETS_SUPPORT} * (SELECT count(*) FROM documents))),
 mc AS (SELECT ceil({C.FP_SETS_SUPPORT} * (SELECT count(*) FROM documents)) AS m),
 sets(items, last, freq) AS (
   SELECT [item], item, support FROM f1
   UNION ALL
   SELECT c.items, c.last, c.freq FROM (
     SELECT list_append(s.items, f.item) AS items, f.item AS last,
            (SELECT count(*) FROM t WHERE list_has_all(t.items, list_append(s.items, f.item))) AS freq
     FROM sets s JOIN f1 f ON f.item > s.last) c
   WHERE c.freq >= (SELECT m FROM mc))
SELECT array_to_string(items, ' ') AS items, freq FROM sets
"""


@query("fp_growth_itemsets", _FP_SQL)
def fp_growth_itemsets(spark, sf_dir):
    """Frequent itemsets of the case items (Spark ML FP-growth)."""
    sets, _ = MN.fp_growth(CaseModel(spark, sf_dir).items, C.FP_SETS_SUPPORT)
    return sets.select(F.array_join(F.array_sort("items"), " ").alias("items"), "freq")


@query("lda_topic_terms")
def lda_topic_terms(spark, sf_dir):
    """(topic, term, weight) of the EM LDA over weighted case vectors."""
    return CaseModel(spark, sf_dir).lda_topics


@query("kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    """(case_id, cluster, dist2) by Spark ML k-means, k = 20 + 5, 20 iterations."""
    pts = CaseModel(spark, sf_dir).points
    model, _, _ = CL.choose_k(pts)
    return CL.kmeans_assign(pts, model).select("case_id", "cluster", "dist2")


@query("lda_topic_checks", f"""
SELECT topic, count(DISTINCT token) AS terms, 1.0::DOUBLE AS weight
FROM {P.CLEAN_TOKENS} t, range(0, {C.LDA_TOPICS}) k(topic) GROUP BY topic
""")
def lda_topic_checks(spark, sf_dir):
    """By definition every topic spreads a weight of 1 over the vocabulary."""
    topics = CaseModel(spark, sf_dir).lda_topics
    return topics.groupBy(F.col("topic").cast("long").alias("topic")).agg(
        F.countDistinct("term").alias("terms"), F.round(F.sum("weight"), 6).alias("weight"))


@query("lda_mass_checks", f"""
SELECT v.term, v.df, w.weight AS weight, w.weight AS weight_after FROM {_TERM_DF} v
JOIN ({_weights_sql(_TOKEN_MATCH)}) w ON w.term = v.term
""")
def lda_mass_checks(spark, sf_dir):
    """No weight is lost or made: all topics together hold of a term what the
    cases' vectors hold, a weight per case, also after one more step."""
    m = CaseModel(spark, sf_dir)
    return m.lda_mass.join(m.term_df, "term").select(
        "term", "df", F.round(F.col("mass") / F.col("df"), 6).alias("weight"),
        F.round(F.col("mass_after") / F.col("df"), 6).alias("weight_after"))


@query("lda_high_value_checks", f"""
SELECT topic, count(*) AS n_terms, floor(count(*) * {C.TOPIC_TOP_FRACTION})::BIGINT AS n_top, true AS best_taken,
       true AS all_in_union
FROM {_TERM_DF} v, range(0, {C.LDA_TOPICS}) k(topic) WHERE length(term) >= {C.TOPIC_MIN_TERM_LENGTH} GROUP BY topic
""")
def lda_high_value_checks(spark, sf_dir):
    """High-value terms from LDA topics: of each topic's terms the best share is
    taken, no term left out weighs more, and all of them are in the union."""
    m = CaseModel(spark, sf_dir, topics="lda")
    scores = m.topic_scores.where(F.length("term") >= C.TOPIC_MIN_TERM_LENGTH)
    top = m.topic_top.select("topic", "term", F.lit(1).alias("top"))
    union = m.hv_terms.select("term", F.lit(1).alias("hv"))
    flagged = scores.join(top, ["topic", "term"], "left").join(union, "term", "left")
    taken = F.col("top").isNotNull()
    return flagged.groupBy(F.col("topic").cast("long").alias("topic")).agg(
        F.count(F.lit(1)).alias("n_terms"), F.count("top").alias("n_top"),
        (F.min(F.when(taken, F.col("score"))) >= F.max(F.when(~taken, F.col("score")))).alias("best_taken"),
        (F.count_if(taken & F.col("hv").isNull()) == 0).alias("all_in_union"))


@query("kmeans_checks", f"""
SELECT count(*) AS cases, count(DISTINCT doc_id) AS distinct_cases, count(*) AS in_range,
       count(*) AS at_nearest, true AS cost_is_sum
FROM documents
""")
def kmeans_checks(spark, sf_dir):
    """By definition every case has one cluster in 0..k-1, its centre is the
    nearest one, and the cost is the sum of squared distances."""
    m = CaseModel(spark, sf_dir, centres="kmeans")
    model, _, history = CL.choose_k(m.points)
    mine = CL.kmeans_assign(m.points, model)
    # distances to all k centres, computed apart from the assignment
    centres = F.explode(F.array(*[F.struct(F.lit(float(c[0])).alias("x"), F.lit(float(c[1])).alias("y"))
                                  for c in model.clusterCenters()]))
    far = mine.withColumn("c", centres).groupBy("case_id", "cluster", "dist2").agg(
        F.min((F.col("x") - F.col("c.x")) ** 2 + (F.col("y") - F.col("c.y")) ** 2).alias("least"))
    return far.agg(F.count(F.lit(1)).alias("cases"), F.countDistinct("case_id").alias("distinct_cases"),
                   F.count_if(F.col("cluster").between(0, K - 1)).alias("in_range"),
                   F.count_if(F.abs(F.col("dist2") - F.col("least")) <= 1e-6).alias("at_nearest"),
                   (F.abs(F.sum("dist2") - history[-1][1]) <= 1e-6 * (history[-1][1] + 1)).alias("cost_is_sum"))


@query("case_report_lda_checks", """
SELECT count(*) AS cases, 0::BIGINT AS singletons FROM documents
""")
def case_report_lda_checks(spark, sf_dir):
    """By definition the report holds every case but those alone in their
    cluster: reported and left-out cases add up, no reported cluster is one."""
    m = CaseModel(spark, sf_dir, topics="lda", centres="kmeans")
    sizes = m.report.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    alone = m.assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
    return sizes.select("n", (F.col("n") < 2).alias("one")).unionByName(alone.select("n", F.lit(False).alias("one"))) \
        .agg(F.sum("n").alias("cases"), F.count_if("one").alias("singletons"))


_NB_PREDICTIONS_SQL = _NB_PRED + "SELECT case_id, prediction FROM pred"


@query("nb_predictions", _NB_PREDICTIONS_SQL)
def nb_predictions(spark, sf_dir):
    """Class of every case, by the naive Bayes model of the labels."""
    m, _, classes, probs = _nb(spark, sf_dir)
    return NB.predict_cases(m.corpus, classes, probs, NB.class_list(classes), m.cases, m.term_df)


_NB_CLUSTERS_SQL = (_NB_OF.replace("LABELS", f"SELECT case_id, cluster AS label FROM {_ASSIGNED} a")
                    + _PREDICT + "SELECT case_id, prediction FROM pred")


def _nb_clusters(spark, sf_dir):
    """Naive Bayes fitted on the clustered cases."""
    m = CaseModel(spark, sf_dir)
    labels = m.assigned.select("case_id", F.col("cluster").cast("long").alias("label"))
    # the labels join the cases' rows, which are fewer than their tokens
    pairs = TK.explode_tokens(m.corpus_arrays.join(labels, "case_id"), ("label",))
    classes, probs = NB.fit_pairs(pairs, labels, m.term_df.count())
    return m, classes.checkpoint(eager=True), probs.checkpoint(eager=True)


@query("nb_cluster_predictions", _NB_CLUSTERS_SQL)
def nb_cluster_predictions(spark, sf_dir):
    """Cases matched to the clusters."""
    m, classes, probs = _nb_clusters(spark, sf_dir)
    return NB.predict_cases(m.corpus, classes, probs, NB.class_list(classes), m.cases, m.term_df)


@query("stream_nb_cluster_predictions", _NB_CLUSTERS_SQL)
def stream_nb_cluster_predictions(spark, sf_dir):
    """The same on a stream of cases, by the newest published version of the
    model (must equal ``nb_cluster_predictions``)."""
    m, classes, probs = _nb_clusters(spark, sf_dir)
    run_id = uuid.uuid4().hex[:12]
    models = ModelVersions(scratch_path(spark, f"models_{run_id}"))
    models.publish(spark, classes, probs)
    docs = S.table(spark, sf_dir, "documents")
    stream = file_stream(spark, os.path.join(sf_dir, "documents.parquet"), docs)
    cases = stream.select(F.col("doc_id").alias("case_id"), F.col("text").alias("history"))
    out = scratch_path(spark, f"cluster_predictions_{run_id}")
    SC.run_versioned_scoring(cases, m.notes, out, scratch_path(spark, f"cluster_predictions_ckpt_{run_id}"),
                             models).awaitTermination()
    return spark.read.parquet(out).select("case_id", "prediction")


@query("stream_nb_predictions", _NB_PREDICTIONS_SQL)
def stream_nb_predictions(spark, sf_dir):
    """The same cases arriving as a stream: cleaned on the stream and scored per
    micro-batch (must equal ``nb_predictions``)."""
    m, _, classes, probs = _nb(spark, sf_dir)
    docs = S.table(spark, sf_dir, "documents")
    stream = file_stream(spark, os.path.join(sf_dir, "documents.parquet"), docs)
    cases = stream.select(F.col("doc_id").alias("case_id"), F.col("text").alias("history"))
    run_id = uuid.uuid4().hex[:12]
    out = scratch_path(spark, f"nb_predictions_{run_id}")
    q = SC.run_scoring(cases, m.notes, out, scratch_path(spark, f"nb_predictions_ckpt_{run_id}"), classes, probs)
    q.awaitTermination()
    return spark.read.parquet(out).select("case_id", "prediction")


@query("case_report_lda")
def case_report_lda(spark, sf_dir):
    """The original program end to end: high-value terms from EM LDA topics,
    frequent items, (x, y) points, Spark ML k-means (k = 25) and the 12-field
    report of every cluster with at least two cases."""
    return CaseModel(spark, sf_dir, topics="lda", centres="kmeans").report
