"""Word count: a line becomes its space-separated words (map), the counts of a
word are summed as a double (reduce).  Partial aggregation before the shuffle
plays the role of the combiner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_words(lines: DataFrame, column: str = "value") -> DataFrame:
    """(word, one): every word of every line, repeats kept."""
    return lines.select(F.explode(F.split(F.col(column), " ")).alias("word"), F.lit(1).alias("one"))


def reduce_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("word").agg(F.sum("one").cast("double").alias("total"))


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    return reduce_counts(map_words(lines, column))
