"""JDBC source and sink option builders.

The extract is pushed into the database as a derived table (``query`` or a
parenthesised ``dbtable``), read in parallel by range-splitting a numeric
column.  Credentials come from arguments or the environment of the caller,
never from the code.  No database runs in this project's tests: the builders
are unit-tested and the relational extract itself runs on the parquet tables
(``operators.extract``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXACTNESS = 10_000  # of approx_percentile: a range is off by at most rows / EXACTNESS


def _literal(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _bounds(keys: DataFrame, column: str, n: int) -> list:
    """At most n - 1 ascending cuts of a column into parts of about equal rows."""
    shares = F.array(*[F.lit(i / n) for i in range(1, n)])
    got = keys.agg(F.approx_percentile(column, shares, F.lit(EXACTNESS))).first()[0] if n > 1 else None
    return sorted(set(got or []))


def _ranges(column: str, bounds: list) -> list[str]:
    """Predicates that cover every value of a column once; nulls go to the first."""
    if not bounds:
        return [f"({column} = {column} OR {column} IS NULL)"]
    first = f"({column} < {_literal(bounds[0])} OR {column} IS NULL)"
    inner = [f"({column} >= {_literal(a)} AND {column} < {_literal(b)})" for a, b in zip(bounds, bounds[1:])]
    return [first, *inner, f"{column} >= {_literal(bounds[-1])}"]


def balanced_predicates(keys: DataFrame, column: str, n: int, tie: str | None = None) -> list[str]:
    """Predicates that cut a table into about ``n`` parts of equal rows, every
    row in exactly one, for a partitioned read.  ``keys`` holds the numeric
    ``column`` (a sample or an earlier extract of it); cuts are its quantiles, so
    a skewed key makes no fat partition.  A value with more rows than a part
    should have gets parts of its own, cut by the numeric column ``tie``."""
    total = keys.count()
    share = max(total / max(n, 1), 1)
    heavy = keys.where(F.col(column).isNotNull()).groupBy(column).count().where(
        F.col("count") > 1.5 * share).orderBy(column).collect()  # fewer than n rows
    if not heavy or tie is None:
        return _ranges(column, _bounds(keys, column, n))
    values = [r[column] for r in heavy]
    rest = keys.where(~F.coalesce(F.col(column).isin(values), F.lit(False)))
    apart = f"({column} NOT IN ({', '.join(map(_literal, values))}) OR {column} IS NULL)"
    out = [f"{r} AND {apart}" for r in _ranges(column, _bounds(rest, column, max(round(rest.count() / share), 1)))]
    for r in heavy:
        own = keys.where(F.col(column) == F.lit(r[column]))
        out += [f"{column} = {_literal(r[column])} AND {p}"
                for p in _ranges(tie, _bounds(own, tie, max(round(r["count"] / share), 1)))]
    return out


def read_jdbc_balanced(spark: SparkSession, url: str, query: str, predicates: list[str],
                       properties: dict[str, str] | None = None) -> DataFrame:
    """The extract, a partition per predicate (see ``balanced_predicates``)."""
    return spark.read.jdbc(url, f"({query}) t1", predicates=predicates, properties=properties or {})


def jdbc_read_options(url: str, query: str, driver: str | None = None, user: str | None = None,
                      password: str | None = None, partition_column: str | None = None,
                      lower_bound: int | None = None, upper_bound: int | None = None,
                      num_partitions: int | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if partition_column:
        # partitioned reads need dbtable (a derived table), not the query option
        opts["dbtable"] = f"({query}) t1"
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions or 1))
    else:
        opts["query"] = query
    if driver:
        opts["driver"] = driver
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(**kwargs)).load()


def jdbc_write_options(url: str, table: str, driver: str | None = None, user: str | None = None,
                       password: str | None = None, column_types: str | None = None,
                       batch_size: int = 10_000) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    if driver:
        opts["driver"] = driver
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if column_types:
        opts["createTableColumnTypes"] = column_types
    return opts


def write_jdbc(df: DataFrame, mode: str = "append", **kwargs) -> None:
    df.write.format("jdbc").options(**jdbc_write_options(**kwargs)).mode(mode).save()
