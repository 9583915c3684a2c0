"""Streaming sinks.

* ``console_batch``: print a micro-batch (smoke only).
* ``KeyedLog``: a keyed table written by ``foreachBatch``.  Every micro-batch
  writes its rows into ``log/batch_id=<id>`` with dynamic partition overwrite,
  so a replayed batch (after a failure) replaces exactly its own output: the
  sink is idempotent.  Reading folds snapshot and newer batches per key: the
  newest row (``latest``, an upsert) or the sum (``added``).  ``compact`` folds
  everything up to a batch into a snapshot and publishes it as a new version: a
  manifest file that appears by one rename and says up to which batch the snapshot
  goes.  Files of the last ``keep`` versions stay, so a reader that opened one of
  them never meets a deletion, and ``read`` can go back to them.
* ``offset_ranges``: per-partition first/last offset and record count of a
  batch read from a partitioned log such as Kafka.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def console_batch(batch: DataFrame, batch_id: int, rows: int = 20) -> None:
    print(f"batch {batch_id}")
    batch.show(rows, truncate=False)


def latest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For every key the row of the newest batch."""
    values = [c for c in log.columns if c not in {*keys, "batch_id"}]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*values, "batch_id"), "batch_id").alias("_v")) \
        .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in [*values, "batch_id"]])


def added(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For every key the sums over all batches."""
    values = [c for c in log.columns if c not in {*keys, "batch_id"}]
    return log.groupBy(*keys).agg(*[F.sum(c).cast(dict(log.dtypes)[c]).alias(c) for c in values],
                                  F.max("batch_id").alias("batch_id"))


class KeyedLog:
    def __init__(self, path: str, keys: Sequence[str], schema: str, fold: Callable = latest):
        """``schema``: DDL of the rows, keys included, batch_id not."""
        self.path, self.keys, self.schema, self.fold = path, list(keys), schema, fold

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The foreachBatch function."""
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{self.path}/log"))

    def _fs(self, spark: SparkSession):
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def _numbers(self, spark: SparkSession, folder: str, name: str) -> list[int]:
        """The values of the partition folders ``name=<n>`` of a folder."""
        fs, path = self._fs(spark)
        at = path(f"{self.path}/{folder}")
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))

    def versions(self, spark: SparkSession) -> dict[int, int]:
        """Published versions: number -> last batch of its snapshot.  Version 0
        is the log without a snapshot."""
        fs, path = self._fs(spark)
        at = path(f"{self.path}/manifest")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        marks = [n.split("-") for n in names if n.startswith("v")]
        found = {int(v[1:]): int(through) for v, through in marks}
        gone = self._numbers(spark, "dropped", "version")  # versions whose files went
        return {v: t for v, t in {0: -1, **found}.items() if v > max(gone, default=-1)}

    def _publish(self, spark: SparkSession, version: int, through: int) -> bool:
        """Make a snapshot the newest version, by one rename; False if another
        writer published this version first."""
        fs, path = self._fs(spark)
        if any(v >= version for v in self.versions(spark)):
            return False
        made = path(f"{self.path}/manifest/.{version}-{uuid.uuid4().hex}")
        fs.create(made).close()
        return fs.rename(made, path(f"{self.path}/manifest/v{version}-{through}"))

    def _rows(self, spark: SparkSession, through: int | None = None, version: int | None = None) -> DataFrame:
        schema = f"{self.schema}, batch_id long"
        known = self.versions(spark)
        if version is not None and version not in known:
            raise ValueError(f"version {version} is not kept; there are {sorted(known)}")
        snap = known[max(known) if version is None else version]
        out = spark.createDataFrame([], schema)
        if snap >= 0:
            out = out.unionByName(spark.read.schema(schema).parquet(f"{self.path}/snapshots/through={snap}"))
        newer = [n for n in self._numbers(spark, "log", "batch_id") if n > snap and (through is None or n <= through)]
        if newer:
            parts = [f"{self.path}/log/batch_id={n}" for n in newer]
            out = out.unionByName(spark.read.schema(schema).option("basePath", f"{self.path}/log").parquet(*parts))
        return out

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The folded table; empty before the first batch.  ``version``: from
        this version's snapshot on (any kept one gives the same rows)."""
        return self.fold(self._rows(spark, version=version), self.keys).drop("batch_id")

    def compact(self, spark: SparkSession, through: int | None = None, keep: int = 1) -> int:
        """Fold all batches up to ``through`` (default: the newest) into one
        snapshot, publish it, and drop what no version of the last ``keep``
        needs.  A reader sees the old or the new version; a crash in between
        leaves the old one."""
        known = self.versions(spark)
        newest = max(known)
        batches = self._numbers(spark, "log", "batch_id")
        through = max(batches, default=-1) if through is None else through
        if through <= known[newest]:
            return known[newest]
        self.fold(self._rows(spark, through), self.keys).write.mode("overwrite").parquet(
            f"{self.path}/snapshots/through={through}")
        if self._publish(spark, newest + 1, through):
            self._drop(spark, keep)
        return through

    def _drop(self, spark: SparkSession, keep: int) -> None:
        """Delete what only versions before the last ``keep`` read."""
        fs, path = self._fs(spark)
        known = self.versions(spark)
        kept = sorted(known)[-max(keep, 1):]
        gone = [v for v in known if v not in kept]
        if not gone:
            return
        fs.mkdirs(path(f"{self.path}/dropped/version={max(gone)}"))  # first: no new reader opens them
        oldest = known[kept[0]]
        for n in self._numbers(spark, "log", "batch_id"):
            if n <= oldest:
                fs.delete(path(f"{self.path}/log/batch_id={n}"), True)
        for n in self._numbers(spark, "snapshots", "through"):
            if n < oldest:
                fs.delete(path(f"{self.path}/snapshots/through={n}"), True)


def offset_ranges(batch: DataFrame, partition: str = "partition", offset: str = "offset") -> DataFrame:
    return batch.groupBy(partition).agg(F.min(offset).alias("from_offset"),
                                        F.max(offset).alias("until_offset"),
                                        F.count(F.lit(1)).alias("records"))
