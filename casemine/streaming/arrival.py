"""Sliding word counts by arrival, added and taken off pane by pane, zeros kept.

A line counts from the pane (10 seconds) in which it arrives until 30 panes
later.  A word's count changes only when one of its panes comes or leaves, so
that is when it gets a row (pane, word, count); between two rows it stays, and a
word whose last pane has left has a row with 0, which stays too.  ``as_of`` rolls
the rows out: the count of every word seen so far, at any pane.

On a stream each micro-batch adds what arrived and takes off what left since the
batch before, from three tables below ``path``, one folder per batch and table:
the panes, the rows, and the state (the count of every word and the last pane).
A batch reads only older batches and overwrites its own folders, so a replayed
one gives what it gave before, and a restart goes on from the tables.  Arrival
never goes back: a line dated before the last pane counts as arriving in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PANES = 30
SLIDE = 10  # seconds


def pane_number(ts: Column, slide: int = SLIDE) -> Column:
    micros = F.unix_micros(ts)
    return ((micros - F.pmod(micros, F.lit(slide * 1_000_000))) / F.lit(slide * 1_000_000)).cast("long")


def panes_of(words: DataFrame, slide: int = SLIDE, not_before: int | None = None) -> DataFrame:
    """(pane, word, n) of words (ts, word)."""
    pane = pane_number(F.col("ts"), slide)
    if not_before is not None:
        pane = F.greatest(pane, F.lit(not_before))
    return words.where(F.col("word").isNotNull()).groupBy(pane.alias("pane"), "word").agg(F.count(F.lit(1)).alias("n"))


def moves(panes: DataFrame, size: int = PANES) -> DataFrame:
    """(pane, word, n): what a pane adds when it comes and takes off when it leaves."""
    return panes.select("pane", "word", "n").unionByName(
        panes.select((F.col("pane") + size).alias("pane"), "word", (-F.col("n")).alias("n")))


def counts_of(moved: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """(pane, word, count): the running count of every word at each of its
    moves, from its count in ``state`` (word, count) on."""
    steps = moved.groupBy("pane", "word").agg(F.sum("n").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("word").orderBy("pane"))
    if state is None:
        return steps.select("pane", "word", so_far.cast("long").alias("count"))
    return steps.withColumn("n", so_far).join(state.select("word", "count"), "word", "left").select(
        "pane", "word", (F.col("n") + F.coalesce("count", F.lit(0))).cast("long").alias("count"))


def arrival_counts(words: DataFrame, slide: int = SLIDE, size: int = PANES) -> DataFrame:
    """The rows of a table of words (ts, word), up to its last pane."""
    panes = panes_of(words, slide)
    last = panes.agg(F.max("pane")).first()[0]
    return counts_of(moves(panes, size).where(F.col("pane") <= F.lit(last if last is not None else -1)))


def as_of(rows: DataFrame, pane: int) -> DataFrame:
    """(word, count) at a pane: the last row up to it; words at 0 stay."""
    return rows.where(F.col("pane") <= pane).groupBy("word").agg(F.max_by("count", "pane").alias("count"))


class ArrivalCounts:
    """The tables of one stream."""

    SCHEMAS = {"panes": "pane long, word string, n long, batch_id long",
               "rows": "pane long, word string, count long, batch_id long",
               "state": "word string, count long, last_pane long, batch_id long"}

    def __init__(self, path: str, slide: int = SLIDE, size: int = PANES):
        self.path, self.slide, self.size = path, slide, size

    def _put(self, df: DataFrame, table: str, batch_id: int) -> DataFrame:
        at = f"{self.path}/{table}/batch_id={batch_id}"
        df.write.mode("overwrite").parquet(at)
        return df.sparkSession.read.schema(df.schema).parquet(at)

    def _batches(self, spark: SparkSession, table: str) -> list[int]:
        """Batches whose folder of a table is complete."""
        jvm = spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        done = [int(n.split("=")[1]) for n in names if n.startswith("batch_id=")
                and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}/{n}/_SUCCESS"))]
        return sorted(done)

    def _read(self, spark: SparkSession, table: str, batches: list[int]) -> DataFrame:
        schema = self.SCHEMAS[table]
        if not batches:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(
            *[f"{self.path}/{table}/batch_id={b}" for b in batches])

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The foreachBatch function over words (ts, word)."""
        spark = batch.sparkSession
        before = [b for b in self._batches(spark, "state") if b < batch_id]
        state = self._read(spark, "state", before[-1:])
        last = state.agg(F.max("last_pane")).first()[0]
        new = self._put(panes_of(batch, self.slide, last), "panes", batch_id)
        now = new.agg(F.max("pane")).first()[0]
        if now is None:
            return  # nothing arrived
        start = last if last is not None else now - self.size - 1
        old = self._read(spark, "panes", [b for b in self._batches(spark, "panes") if b < batch_id]).where(
            F.col("pane") > F.lit(start - self.size))
        leave = old.select("pane", "word", "n").unionByName(new).select(
            (F.col("pane") + self.size).alias("pane"), "word", (-F.col("n")).alias("n"))
        if last is not None:
            leave = leave.where(F.col("pane") > last)
        moved = new.unionByName(leave.where(F.col("pane") <= now))
        rows = self._put(counts_of(moved, state), "rows", batch_id)
        latest = rows.groupBy("word").agg(F.max_by("count", "pane").alias("count"))
        kept = state.select("word", "count").join(latest.select("word"), "word", "left_anti")
        self._put(kept.unionByName(latest).withColumn("last_pane", F.lit(now).cast("long")), "state", batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """(pane, word, count): of a pane that went on in a later batch the later row."""
        rows = self._read(spark, "rows", self._batches(spark, "rows"))
        return rows.groupBy("pane", "word").agg(F.max_by("count", "batch_id").alias("count"))


def run_arrival(words: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                slide: int = SLIDE, size: int = PANES):
    """Start counting a stream of words (ts: arrival, word); returns the query."""
    return (words.writeStream.foreachBatch(ArrivalCounts(path, slide, size).write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
