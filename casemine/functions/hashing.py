"""md5-derived numbers as column expressions.

The 128-bit md5 value has no Spark type (it exceeds DECIMAL(38,0)), so the
exact remainder ``md5(s) mod m`` is folded over the four 32-bit chunks of the
hex digest (Horner's rule); every intermediate fits in a long.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .text import col_


def md5_hex(c: Column | str) -> Column:
    return F.md5(col_(c).cast("string"))


def _chunk(hexstr: Column, i: int) -> Column:
    return F.conv(F.substring(hexstr, 1 + 8 * i, 8), 16, 10).cast("long")


def md5_mod(c: Column | str, m: int) -> Column:
    """Exact ``md5(c) mod m`` of the unsigned 128-bit digest."""
    h = md5_hex(c)
    step = (1 << 32) % m
    acc = F.lit(0).cast("long")
    for i in range(4):
        acc = F.pmod(acc * F.lit(step) + _chunk(h, i), F.lit(m))
    return acc


def md5_unit(c: Column | str) -> Column:
    """Top 32 bits of md5 scaled to [0, 1): a bounded stand-in for md5.toDouble."""
    return _chunk(md5_hex(c), 0) / F.lit(C.HASH_SCALE)
