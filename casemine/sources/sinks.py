"""Batch sinks for results: parquet tables and the ``%``-joined text report."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_text_lines(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One text line per row of a single string column (``saveAsTextFile`` form)."""
    lines.write.mode(mode).text(path)
