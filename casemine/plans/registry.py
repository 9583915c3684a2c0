"""Named queries over the given tables and their oracle SQL.

Each query takes (spark, sf_dir) and returns a DataFrame over the whole
tables.  ``ORACLE`` holds an equivalent DuckDB statement for every query
whose result is deterministic; iterative/seeded ML results are absent there
and are checked by invariants in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def load_all() -> None:
    # importing the modules registers their queries
    from . import (text_queries, extract_queries, case_queries, term_queries,  # noqa: F401
                   cluster_queries, stream_queries, ml_queries, posting_queries, related_queries)
