"""Table sources and the mapping of the given tables onto the case model.

Case model (one row per case):
    case_id, customer, series, product, platform, cause, history, title
built from ``documents``:
    case_id = doc_id, history = text, series = lang, product = customer =
    platform = source (one source has an unset platform), cause = lang || '--' ||
    source, title = first line of text.
Note log (many rows per case) from ``conversations``:
    case_id = conv_id, note = turn, owner = role, text = text.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import pack

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan over the cluster's task slots when it yields fewer
    partitions than slots (a file with a single row group is one task).  At
    scale a scan already has many more partitions and this is a no-op."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


UNSET_PLATFORM_SOURCE = "src13"  # a source whose cases say "Please specify"


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents"))
    return d.select(
        F.col("doc_id").alias("case_id"),
        F.col("source").alias("customer"),
        F.col("lang").alias("series"),
        F.col("source").alias("product"),
        F.when(F.col("source") == UNSET_PLATFORM_SOURCE, "Please specify").otherwise(F.col("source")).alias("platform"),
        pack("lang", "source").alias("cause"),
        F.col("text").alias("history"),
        F.split(F.col("text"), "\n").getItem(0).alias("title"),
    )


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("case_id"), F.col("turn").alias("note"),
                    F.col("role").alias("owner"), F.col("text"))
