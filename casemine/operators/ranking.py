"""Exact row numbers over a global order (or within groups) without funnelling
a whole group through one task.

``Window.partitionBy(g).orderBy(...)`` puts each group into a single task; a
global window puts everything into one.  Here rows are range-partitioned on
(group, order) into balanced partitions, sorted and numbered there, and shifted
by the row counts of the earlier partitions (one row per partition, broadcast).
Within a group the number counts from the group's first place.  The numbered
data is checkpointed to the shared checkpoint folder so every consumer sees the
same places, also after an executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .broadcast import bounded_broadcast


def row_number_within(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                      name: str = "rn", num_partitions: int | None = None,
                      size_name: str | None = None) -> DataFrame:
    """Row number ``name`` (1-based) of every row in ``order`` within its
    group; with ``size_name`` also the group's row count, taken from the same
    per-partition counts (no second pass over the input)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(g) for g in group_cols] + list(order)
    # rows already lie in their range, so a sort inside the partition is enough:
    # the low 33 bits of the id are the row's place in its partition
    parted = (df.repartitionByRange(num_partitions, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    pid = F.shiftright("_mid", 33)
    counts = parted.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    # one row per partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    place = F.col("_off") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    out = (parted.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid")
           .withColumn(name, place.cast("long")).drop("_pid", "_off", "_mid"))
    if group_cols:
        # a group's first global place, to count from; its size comes along
        spans = out.groupBy(*group_cols).agg(F.min(name).alias("_start"),
                                             F.count(F.lit(1)).cast("long").alias(size_name or "_size"))
        out = out.alias("o").join(
            bounded_broadcast(spans, 100_000).alias("s"),
            reduce(and_, [F.col(f"o.{g}").eqNullSafe(F.col(f"s.{g}")) for g in group_cols]))
        kept = [F.col(f"o.{c}") for c in df.columns]
        kept.append((F.col(f"o.{name}") - F.col("s._start") + 1).cast("long").alias(name))
        return out.select(*kept, *([F.col(f"s.{size_name}")] if size_name else []))
    if size_name:  # one number
        total = counts.agg(F.coalesce(F.sum("_cnt"), F.lit(0))).first()[0]
        out = out.withColumn(size_name, F.lit(total).cast("long"))
    return out
