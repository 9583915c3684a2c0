"""Corpus pipeline: five stages from raw documents to token ids.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
stages are written as Parquet to the shared checkpoint folder and read again.
All but the last return the columns of ``documents``.

A decision is carried back to its rows by (doc_id, hash of the text), null ids
included, so tables with repeated or missing ids keep the right rows.

Edge cases: a null text is a document like any other (its copies are copies of
the empty text; it holds no passage or item and encodes to no ids); very long
texts are worked off whole; of a row given several times one stays; ties between
copies go to the smallest id; an empty table gives an empty result; other
columns are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemine.llm import bpe, decontaminate, quality, simhash, suffix_dedup
from casemine.llm.queries import bpe_path
from casemine.session import scratch_path
from casemine.sources.tables import table

ORACLE_SQL = None  # the classifier and the vocabulary can't be said in SQL


def _rows_of(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text_hash) is (not) among ``keys``."""
    d = docs.alias("d")
    k = keys.select("doc_id", "text_hash").distinct().alias("k")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & F.xxhash64("d.text").eqNullSafe(F.col("k.text_hash"))
    return d.join(k, same, how).select("d.*")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    judged = quality.classify(docs, model, host=F.col("source"), path=F.col("lang"))
    return _rows_of(docs, judged.where(~F.col("keep")), "left_anti")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: its smallest id (null ids
    last, then the smallest text hash)."""
    found = simhash.near_duplicates(docs, shingle=3, max_bits=3)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    keys = found.groupBy("group").agg(first, F.count(F.lit(1)).alias("n")).select("first.doc_id", "first.text_hash")
    kept = _rows_of(docs, keys, "left_semi")
    rows = found.groupBy(F.col("doc_id").alias("i"), "text_hash").agg(F.count(F.lit(1)).alias("n"))
    # a row given twice is only told apart here; most tables have none
    if rows.where("n > 1").isEmpty():
        return kept
    free, taken = "_h", {c.lower() for c in docs.columns}  # a name that no column has
    while free in taken:
        free += "_"
    return kept.withColumn(free, F.xxhash64("text")).dropDuplicates(["doc_id", free]).drop(free)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts; a character that loses some
    of its bytes goes with them.  ``n_chars`` follows the new text."""
    other = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    row = F.struct(F.col("text").isNull().alias("no_text"), *[F.col(c) for c in other])
    got = suffix_dedup.dedup(docs, carry=row, characters=True)
    # bytes that were no UTF-8 before become U+FFFD; the cut makes none
    text = F.when(~F.col("row.no_text"), F.make_valid_utf8(F.col("kept").cast("string")))
    kinds = dict(docs.dtypes)
    columns = {"doc_id": F.col("doc_id").cast(kinds["doc_id"]), "text": text,
               "n_chars": F.length(text).cast(kinds.get("n_chars", "long"))}
    return got.select(*[(columns[c] if c in columns else F.col(f"row.{c}")).alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return _rows_of(docs, decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit integers)."""
    return bpe.encode(docs, bpe_path())


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_near_copies),
    ("repeated_passages", cut_repeats),
    ("decontamination", drop_leaks),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    folder = scratch_path(spark, f"corpus-{uuid.uuid4().hex}")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = os.path.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
