"""Line dictionaries (stop words, names, templates): one entry per line.

Read with ``spark.read.text``: trimmed, lower-cased, empty lines dropped,
de-duplicated.  A word list read this way filters tokens by an anti join
(``operators.tokens.drop_words``), broadcast only after a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_word_list(spark: SparkSession, path: str, lower: bool = True) -> DataFrame:
    v = F.trim(F.col("value"))
    if lower:
        v = F.lower(v)
    return spark.read.text(path).select(v.alias("word")).where(F.col("word") != "").distinct()


MAX_TEMPLATES = 10_000  # templates become literals of the plan


def read_templates(spark: SparkSession, path: str) -> list[str]:
    """Templates in file order: ``<required> words <optional>``, one per line.
    The position in the list is the template's id."""
    lines = spark.read.text(path, wholetext=False).coalesce(1).select(F.trim("value").alias("template"))
    rows = lines.where(F.col("template") != "").limit(MAX_TEMPLATES + 1).collect()
    if len(rows) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates in {path}")
    return [r["template"] for r in rows]
