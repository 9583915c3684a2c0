"""Weighted document vectors, LDA topics, frequent itemsets.

Vectors: the tokens of a block of cases, each once, are joined with the term ids
and weights; neither vocabulary nor weights pass through the driver.  Topics: EM LDA over
blocks of documents (``topics.py``); a saved model holds its counts as tables
with a row per term and document, and the entries packed by block; the
topic-term table is read from the counts, distributed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import collect_garbage, ensure_checkpoint_dir
from . import topics as TO
from .broadcast import bounded_values
from .terms import frequent_items


def weighted_terms(vocabulary: DataFrame, weights: DataFrame) -> DataFrame:
    """(token, term_id, n, df): what the vectors of the cases hold for a token, the
    weight ``n`` at its term id, and the term's document frequency."""
    return vocabulary.select("term", "term_id", "df").join(weights, "term", "left").select(
        F.col("term").alias("token"), "term_id", F.coalesce("weight", F.lit(1.0)).alias("n"), "df")


def vector_entries(docs: DataFrame) -> DataFrame:
    """Entries of documents given as vectors (``features``), a document a row."""
    def parts(v):
        if hasattr(v, "indices"):
            return v.indices.tolist(), v.values.tolist()
        return list(range(len(v))), v.tolist()

    split = F.udf(parts, "struct<term_id: array<long>, n: array<double>>")
    rows = docs.select(F.monotonically_increasing_id().alias("case_id"), split("features").alias("v"))
    return rows.select("case_id", F.explode(F.arrays_zip("v.term_id", "v.n")).alias("e")).select(
        "case_id", "e.term_id", "e.n", F.lit(None).cast("long").alias("df")).where("n > 0")


def lda_priors(vocab_size: int, k: int = C.LDA_TOPICS) -> tuple[float, float]:
    return float(C.LDA_ALPHA_NUMERATOR // k), C.LDA_BETA_NUMERATOR / vocab_size + 1.0


def fit_lda(docs: DataFrame, vocab_size: int, k: int = C.LDA_TOPICS, iterations: int = C.LDA_ITERATIONS,
            seed: int = 7, n_entries: int | None = None, terms: DataFrame | None = None) -> TO.Fitted:
    """EM LDA of tokens (case_id, tokens) with their ``weighted_terms``, of entries
    (case_id, term_id, n, df) or of vectors (``features``)."""
    alpha, beta = lda_priors(vocab_size, k)
    if terms is not None:
        n_entries = docs.agg(F.sum(F.size("tokens"))).first()[0] or 0 if n_entries is None else n_entries
        return TO.fit_tokens(docs, terms, n_entries, vocab_size, alpha, beta, k, iterations, seed)
    entries = vector_entries(docs) if "features" in docs.columns else docs
    return TO.fit(entries, entries.count() if n_entries is None else n_entries, vocab_size, alpha, beta, k, iterations, seed)


def topic_terms(counts: DataFrame, totals: list[float], vocabulary: DataFrame) -> DataFrame:
    """(topic, term, weight): the term's count in the topic over the topic's total."""
    each = counts.select("term_id", F.posexplode("counts").alias("topic", "n"))
    total = F.array(*[F.lit(t) for t in totals])  # a number per topic
    return each.join(vocabulary.select("term_id", "term"), "term_id").select(
        "topic", "term", (F.col("n") / F.element_at(total, F.col("topic") + 1)).alias("weight"))


def lda_counts(spark, path: str) -> tuple[DataFrame, DataFrame, DataFrame, list[float]]:
    """What a saved EM model rests on: (term_id, counts) and (doc, counts), an
    array with a number per topic each; (block, size, payload), the entries of the
    vectors it was fitted on, packed by block of documents; the topics' totals."""
    terms, docs, entries, totals = (spark.read.parquet(f"{path}/{name}") for name in ("terms", "docs", "entries", "totals"))
    return terms, docs, entries, list(totals.first()[0])


def expectation_step(entries: DataFrame, by_term: DataFrame, by_doc: DataFrame, totals: list[float],
                     vocab_size: int, alpha: float, beta: float) -> DataFrame:
    """(term_id, counts) after one more step of EM LDA: every entry's number is
    dealt over the topics in proportion to (the term's count + beta - 1) (the
    document's count + alpha - 1) / (the topic's total + (beta - 1) V), then
    summed up per term.  The counts are moved to the blocks of entries, and a
    block's sums per term away from it; entries are not taken apart."""
    k = len(totals)

    def words(batches):
        for batch in batches:
            for d, size, payload in zip(*(batch.column(i) for i in range(3))):
                found = TO.unpacked(size.as_py(), payload.as_py())["words"]
                for i in range(0, len(found), TO.ROWS):
                    part = found[i:i + TO.ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), d.as_py())), pa.array(np.arange(i, i + len(part))), pa.array(part)],
                        names=["block", "place", "term_id"])

    def step(block: pa.Table, counts: pa.Table) -> pa.Table:
        size, payload = (block.column(name)[0].as_py() for name in ("size", "payload"))
        b = TO.unpacked(size, payload)
        of_doc, place = (counts.column(name).to_numpy() for name in ("of_doc", "place"))
        n = np.stack([counts.column(f"n{t}").to_numpy() for t in range(k)], axis=1)
        docs, terms = (np.zeros((size, k)) for size in (np.count_nonzero(of_doc), len(b["words"])))
        docs[place[of_doc]], terms[place[~of_doc]] = n[of_doc], n[~of_doc]
        shares = [(terms[:, t] + (beta - 1))[b["at"]] * ((docs[:, t] + (alpha - 1)) / (totals[t] + (beta - 1) * vocab_size))[b["doc"]]
                  for t in range(k)]
        each = b["n"] / sum(shares)
        sums = [np.bincount(b["at"], s * each, len(b["words"])) for s in shares]
        return pa.table([pa.array(b["words"]), *map(pa.array, sums)], names=["term_id", *[f"t{t}" for t in range(k)]])

    each = [F.col("counts")[t].alias(f"n{t}") for t in range(k)]
    wanted = entries.mapInArrow(words, "block long, place long, term_id long")
    terms = wanted.join(by_term, "term_id").select("block", "place", F.lit(False).alias("of_doc"), *each)
    docs = by_doc.select(F.shiftright("doc", 33).alias("block"), F.col("doc").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
                         F.lit(True).alias("of_doc"), *each)
    sums = entries.groupBy("block").cogroup(terms.unionByName(docs).groupBy("block")).applyInArrow(
        step, ", ".join(["term_id long", *[f"t{t} double" for t in range(k)]]))
    sums = sums.groupBy("term_id").agg(*[F.sum(f"t{t}").alias(f"t{t}") for t in range(k)])
    return sums.select("term_id", F.array(*[F.col(f"t{t}") for t in range(k)]).alias("counts"))


def save_lda(docs: DataFrame, vocab_size: int, path: str, k: int = C.LDA_TOPICS, iterations: int = C.LDA_ITERATIONS,
             seed: int = 7, n_entries: int | None = None, terms: DataFrame | None = None) -> None:
    """Fit LDA (EM) and save the model's tables below ``path``."""
    spark = docs.sparkSession
    model = fit_lda(docs, vocab_size, k, iterations, seed, n_entries, terms)
    model.terms().write.parquet(f"{path}/terms")
    model.docs().write.parquet(f"{path}/docs")
    model.packed().write.parquet(f"{path}/entries")
    spark.createDataFrame([(model.totals,)], "totals array<double>").write.parquet(f"{path}/totals")
    model.release()
    collect_garbage(spark)


def lda_topics(docs: DataFrame, vocabulary: DataFrame, vocab_size: int, k: int = C.LDA_TOPICS,
               iterations: int = C.LDA_ITERATIONS, seed: int = 7, n_entries: int | None = None,
               terms: DataFrame | None = None) -> DataFrame:
    """Fit LDA (EM) and return its (topic, term, weight) table, written to the
    checkpoint folder."""
    spark = docs.sparkSession
    model = fit_lda(docs, vocab_size, k, iterations, seed, n_entries, terms)
    topics = topic_terms(model.terms(), model.totals, vocabulary).checkpoint(eager=True)
    model.release()
    collect_garbage(spark)
    return topics


def items_with_mates(transactions: DataFrame, column: str, values: list[str], min_count: int) -> list[str]:
    """Those of ``values`` that some other of them is found with in at least
    ``min_count`` transactions: each task counts its pairs in one matrix, and
    the matrices are added up.  An item twice in a transaction is an error, as it
    is for the estimator."""
    if not values:
        return []

    def pairs(batches):
        known, counts = pa.array(values), np.zeros((len(values), len(values)), np.int64)
        for batch in batches:
            lists = batch.column(0)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            place = pc.index_in(lists.flatten(), known).fill_null(-1).to_numpy(zero_copy_only=False)
            has = np.zeros((len(lists), len(values)), np.float32)  # exact: a batch has less than 2^24 rows
            has[row[place >= 0], place[place >= 0]] = 1
            if np.count_nonzero(has) < np.count_nonzero(place >= 0):
                raise ValueError("items in a transaction must be unique")
            counts += (has.T @ has).astype(np.int64)
        a, b = np.nonzero(np.triu(counts, 1))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(counts[a, b])], names=["a", "b", "n"])

    frequent = transactions.select(column).mapInArrow(pairs, "a long, b long, n long").groupBy("a", "b").agg(
        F.sum("n").alias("n")).where(F.col("n") >= min_count)
    found = frequent.select(F.explode(F.array("a", "b")).alias("i")).distinct().collect()  # at most as many as values
    return [values[i] for i in sorted(r["i"] for r in found)]


def fp_growth(items: DataFrame, min_support: float = C.FP_MIN_SUPPORT, items_col: str = "items"):
    """Spark ML FP-growth over per-case item sets; returns (itemsets: items, freq; model).
    The estimator keeps the transactions it is given in memory, as trees whose
    size is measured again and again.  An item that is too rare is in no frequent
    itemset, and one that has no frequent pair is in none but its own; so while a
    checked count proves the frequent items few, the others are taken out first
    (the transactions stay), and itemsets of one item come from their counts."""
    items = items.where(F.col(items_col).isNotNull())
    spark = items.sparkSession
    ensure_checkpoint_dir(spark)
    frequent = frequent_items(items.select(F.col(items_col).alias("items")), min_support).checkpoint(eager=True)
    values = bounded_values(frequent, "item", 1_000)
    alone = None
    if values is not None:
        def only(kept):
            return F.filter(items_col, lambda w: w.isin(kept)) if kept else F.slice(items_col, 1, 0)

        items = items.withColumn(items_col, only(values)).checkpoint(eager=True)
        mates = items_with_mates(items, items_col, values, math.ceil(min_support * items.count()))
        items = items.withColumn(items_col, only(mates))
        alone = frequent.where(~F.col("item").isin(mates)) if mates else frequent
    # a transaction is sent to every group that has one of its items: no more groups than tasks at a time
    model = FPGrowth(itemsCol=items_col, minSupport=min_support, minConfidence=1.0,
                     numPartitions=spark.sparkContext.defaultParallelism).fit(items)
    sets = model.freqItemsets
    if alone is not None:
        sets = sets.unionByName(alone.select(F.array("item").alias("items"), F.col("support").alias("freq")))
    return sets, model
