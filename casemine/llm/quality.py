"""Quality classifier: hierarchical empirical Bayes over hosts and paths.

Evidence.  A logistic model on surface measures of the whole text (symbols,
capitals, repeated and distinct words, word and line lengths), trained on a
bounded sample of labelled rows.  It is trained with both classes at equal
weight, so its log-odds are the log likelihood ratio of the text alone.

Sites.  Documents belong to a path, paths to a host.  All documents, labelled or
not, add their probability of being good to their path's and host's counts
(grouped aggregation).  The spread of the host means around the global mean
gives the strength of the global prior, that of the path means around their
hosts the strength of the host prior (method of moments); host and path means
are shrunk by it, so that a sparse site says what its parent says.  A
document's own vote is taken out of its site before its site speaks about it.

Score.  Posterior odds = likelihood ratio x odds of the site's mean; documents
below ``THRESHOLD`` are rejected.

The site tables are joined on (host, path): aggregates on one side, slim rows
without texts on the other, both checkpointed, so that Spark can split a host
that holds a third of all rows.  To the driver come the training sample and
five global sums.

Edge cases: null and empty texts have no words and are scored on their site
with the evidence of an empty text; null host or path is a site of its own;
without labels of both classes the evidence is neutral and nothing is
rejected; rows come out one for one, whatever their id; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_slices

THRESHOLD = 0.5
STRONGEST = 1e6   # pseudo-documents of a prior whose sites don't differ
MOST_EVIDENCE = 12.0
SYMBOLS = bytes(set(range(33, 127)) - set(b"0123456789") - set(range(65, 91)) - set(range(97, 123)))
PLAIN_SYMBOLS = b".,;:!?'\"()-"
CAPITALS = bytes(range(65, 91))
DIGITS = b"0123456789"


def measures(text: str | None) -> list[float]:
    """Surface measures of a whole text, about 0 to 1 each."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n, w = max(1, len(raw)), max(1, len(words))
    share = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    lines = raw.count(b"\n") + 1
    odd = bytes(set(SYMBOLS) - set(PLAIN_SYMBOLS))
    same = sum(map(bytes.__eq__, words, words[1:]))
    ends = sum(x[-1] in SYMBOLS for x in words)
    return [1.0, min(1.0, 5 * share(odd)), min(1.0, 3 * share(PLAIN_SYMBOLS)), min(1.0, 3 * share(CAPITALS)),
            min(1.0, 5 * share(DIGITS)), min(1.0, raw.count(b"!") * 5 / n), ends / w, same / w,
            len(set(words)) / w if len(words) > 20 else 0.6, min(1.0, n / w / 15), min(1.0, math.log1p(w) / 8),
            min(1.0, w / lines / 40), float(not words)]


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...] = ()
    good: float = 0.5  # share of good labels


def train(rows: list[tuple[str, int]], good: float) -> Model:
    """Ridge logistic regression by Newton steps, classes at equal weight."""
    y = np.array([float(b) for _, b in rows])
    if not 0 < y.sum() < len(y):
        return Model((), good)
    x = np.array([measures(t) for t, _ in rows])
    w = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)
    beta, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 0.5)
    ridge[0] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge),
                               x.T @ (w * (y - p)) - ridge * beta)
        beta = beta + np.clip(step, -5, 5)
    return Model(tuple(map(float, beta)), good)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000, train_bytes: int = 1 << 16,
        doc_id: str = "doc_id", text: str = "text", quality: str = "quality") -> Model:
    """Train on at most ``per_class`` labelled rows of each class, of at most
    ``train_bytes`` bytes, chosen by a hash of the id; an id with several labels
    counts as good only if all of them say so."""
    known = (labels.where(F.col(quality).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("_id")).agg(F.min(F.col(quality).cast("int")).alias("_y")))
    total = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = [known.where(F.col("_y") == y).orderBy(F.xxhash64("_id")).limit(per_class) for y in (0, 1)]
    rows = (docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t"))
            .where(F.octet_length("_t").between(1, train_bytes))
            .join(F.broadcast(wanted[0].unionByName(wanted[1])), "_id").dropDuplicates(["_id"]).collect())
    good = total.get(1, 0) / max(1, total.get(0, 0) + total.get(1, 0))
    return train([(r["_t"], r["_y"]) for r in sorted(rows, key=lambda r: r["_id"])], good)


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(between: float, expected: float) -> float:
    """Pseudo-documents of a Beta prior from the variance of site means beyond
    what their sizes explain."""
    return STRONGEST if between <= expected / STRONGEST else max(1.0, expected / between - 1)


def _between(sites: DataFrame, mean: Column) -> float:
    """Variance of the site means around ``mean``, weighted by documents,
    less the sampling variance of Bernoulli votes."""
    q = F.col("k") / F.col("n")
    got = sites.agg(F.sum(F.col("n") * (q - mean) * (q - mean)), F.sum(F.greatest(mean * (1 - mean), F.lit(0.0))),
                    F.sum("n")).first()
    return max(0.0, ((got[0] or 0.0) - (got[1] or 0.0)) / (got[2] or 1))


def classify(docs: DataFrame, model: Model, host: Column, path: Column, doc_id: str = "doc_id",
             text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, evidence, host_mean, path_mean, score, keep, text_hash`` per
    row; ``evidence`` is the text's log likelihood ratio, ``score`` the
    posterior probability of good quality."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(text).alias("text"))
    prior = min(max(model.good, 1e-3), 1 - 1e-3)
    weights = np.array(model.weights)

    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column(4).to_pylist()
        z = [float(np.clip(np.dot(measures(t), weights), -MOST_EVIDENCE, MOST_EVIDENCE)) if len(weights) else 0.0
             for t in texts]
        return {**{k: batch.column(i) for i, k in enumerate(("doc_id", "text_hash", "host", "path"))}, "evidence": z}

    slim = map_slices(rows, run, "doc_id long, text_hash long, host string, path string, evidence double")
    vote = 1 / (1 + F.exp(-(F.col("evidence") + math.log(prior / (1 - prior)))))
    slim = cut(slim.withColumn("vote", vote))
    paths = cut(slim.groupBy("host", "path").agg(F.sum("vote").alias("k"), F.count(F.lit(1)).alias("n")))
    hosts = cut(paths.groupBy("host").agg(F.sum("k").alias("k"), F.sum("n").alias("n")))
    k, n = hosts.agg(F.sum("k"), F.sum("n")).first()
    mean = min(max((k or 0.0) / n, 1e-3), 1 - 1e-3) if n else prior
    # hosts shrink to the global mean, paths to their host
    to_global = _strength(_between(hosts, F.lit(mean)), mean * (1 - mean))
    same = lambda a, b, c: F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    hosts = hosts.withColumn("host_mean", (F.col("k") + mean * to_global) / (F.col("n") + to_global))
    p, h = paths.alias("p"), hosts.alias("h")
    paths = p.join(h, same("p", "h", "host")).select(
        "p.host", "p.path", "p.k", "p.n", "h.host_mean", F.col("h.k").alias("host_k"), F.col("h.n").alias("host_n"))
    to_host = _strength(_between(paths, F.col("host_mean")), mean * (1 - mean))
    s, p = slim.alias("s"), cut(paths).alias("p")
    joined = s.join(p, same("s", "p", "host") & same("s", "p", "path")).select(
        "s.*", *[f"p.{c}" for c in ("k", "n", "host_k", "host_n")])
    # without the document's own vote
    host_mean = (F.col("host_k") - F.col("vote") + mean * to_global) / (F.col("host_n") - 1 + to_global)
    path_mean = (F.col("k") - F.col("vote") + F.col("host_mean") * to_host) / (F.col("n") - 1 + to_host)
    low, high = F.lit(1e-6), F.lit(1 - 1e-6)
    out = joined.withColumn("host_mean", F.least(high, F.greatest(low, host_mean))) \
        .withColumn("path_mean", F.least(high, F.greatest(low, path_mean)))
    score = 1 / (1 + F.exp(-(F.col("evidence") + _odds(F.col("path_mean")))))
    keep = F.col("score") >= threshold if len(weights) else F.lit(True)
    return out.withColumn("score", score).select("doc_id", "evidence", "host_mean", "path_mean", "score",
                                                 keep.alias("keep"), "text_hash")
