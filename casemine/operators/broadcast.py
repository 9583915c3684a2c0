"""Broadcast only behind a size check.

``bounded_broadcast`` counts the rows of a side (one partial row per task) and
sums their bytes in the same aggregation.
Within both bounds the side is broadcast; beyond them the frame is returned
unchanged and Spark plans a shuffle join (AQE may still switch to a broadcast at
run time from real shuffle sizes).  Callers pass sides that are cheap to compute
twice, or written ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 100_000
DEFAULT_MAX_BYTES = 64 << 20
FIXED_BYTES = 16  # a number and its place in a row


def _row_bytes(df: DataFrame):
    """Bytes of a row as a column: texts by their length, arrays by their
    elements, everything else as a number."""
    size = F.lit(0)
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind == "array":
            text = f.dataType.elementType.typeName() in ("string", "binary")
            size = size + F.coalesce(F.octet_length(F.array_join(c.cast("array<string>"), "")) + F.size(c) * 8
                                     if text else F.size(c) * 8, F.lit(0))
        size = size + FIXED_BYTES
    return size


def is_small(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """Whether a side has at most so many rows and bytes (one aggregation)."""
    got = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df).cast("long"))).first()
    return got[0] <= max_rows and (got[1] or 0) <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def bounded_values(df: DataFrame, column: str, max_rows: int = 1_000) -> list | None:
    """The distinct values of ``column`` when there are at most ``max_rows``
    of them (one more is asked for), else None: the caller then keeps
    its join-based path.  Kept small: every value becomes a literal of the
    plan."""
    found = df.select(column).distinct().limit(max_rows + 1).collect()
    if len(found) > max_rows:
        return None
    return sorted(r[0] for r in found if r[0] is not None)


def join_small(big: DataFrame, small: DataFrame, key: str, how: str,
               max_rows: int = DEFAULT_MAX_ROWS, frequent: DataFrame | None = None) -> DataFrame:
    """Join with a small side: broadcast when a checked count proves it small;
    otherwise a shuffle join with hot keys of ``big`` salted (``skew.py``).
    For ``left_semi``, ``frequent`` names keys of the small side that most rows
    have: within the bounds they are broadcast, and the other rows shuffled."""
    if max_rows > 0 and is_small(small, max_rows):
        return big.join(F.broadcast(small), key, how)
    from .skew import salted_join
    if frequent is None or how != "left_semi" or not is_small(frequent, max_rows):
        return salted_join(big, small, key, how)
    near = F.broadcast(frequent.select(key))
    far = big.join(near, key, "left_anti").where(F.col(key).isNotNull())
    return big.join(near, key, "left_semi").unionByName(salted_join(far, small, key, how))
