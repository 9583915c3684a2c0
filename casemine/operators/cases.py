"""Per-case dimensions and the "given" coordinate.

One scan of the case table feeds every per-case value; sets that the original
program built with one shuffle per column are in-row array expressions here.
Only the owners come from the note log (many rows per case), so they are the
one aggregation (partial ``collect_set`` first, so a case with a huge number
of notes still sends only its distinct owners per map task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from ..functions.hashing import md5_hex, md5_mod


def owners_by_case(notes: DataFrame) -> DataFrame:
    return notes.groupBy("case_id").agg(
        F.array_sort(F.collect_set("owner")).alias("owners"),
        F.count(F.lit(1)).alias("n_notes"))


def cause_words(c) -> F.Column:
    return F.array_distinct(F.split(F.lower(T.null_default(c, C.DEFAULT_CAUSE)), C.PACK_SEPARATOR))


def case_dimensions(cases: DataFrame, notes: DataFrame) -> DataFrame:
    """case_id, customer, series, product, platform, cause_words, title_words,
    owners, n_notes (sets as sorted arrays)."""
    base = cases.select(
        "case_id",
        T.null_default("customer", C.DEFAULT_CUSTOMER).alias("customer"),
        "series", "product",
        T.normalise_platform("platform").alias("platform"),
        F.array_sort(cause_words("cause")).alias("cause_words"),
        F.array_sort(T.word_set("title")).alias("title_words"),
    )
    return base.join(owners_by_case(notes), "case_id", "left").select(
        *base.columns,
        F.coalesce("owners", F.array().cast("array<string>")).alias("owners"),
        F.coalesce("n_notes", F.lit(0)).cast("long").alias("n_notes"))


def case_hashes(cases: DataFrame) -> DataFrame:
    key = F.col("case_id").cast("string")
    return cases.select("case_id", md5_hex(key).alias("md5"),
                        md5_mod(key, 100).alias("mod100"), md5_mod(key, 1000).alias("mod1000"),
                        md5_mod(key, 10000).alias("mod10000"))


def given_value(cases: DataFrame) -> DataFrame:
    """x = (md5(platform) % 10000 + 1000) + (md5(product) % 1000 + 100) +
    md5(series) % 100 + (1 / md5(customer) + 1); the last term is 1 in double
    arithmetic, so x is a whole number.  A missing platform counts as the
    default software, a missing product or series as the default hardware."""
    sw = T.null_default("platform", C.DEFAULT_SOFTWARE)
    product, series = (T.null_default(c, C.DEFAULT_HARDWARE) for c in ("product", "series"))
    return cases.select(
        "case_id",
        (md5_mod(sw, 10000) + 1000 + md5_mod(product, 1000) + 100 + md5_mod(series, 100))
        .cast("double").__add__(F.lit(1.0)).alias("x"))


def given_value_per_note(cases: DataFrame, notes: DataFrame) -> DataFrame:
    """The value summed over every note row of a case, as the note-level join
    of the original program does (cases without notes have no row)."""
    n = notes.groupBy("case_id").agg(F.count(F.lit(1)).alias("n_notes"))
    return given_value(cases).join(n, "case_id", "inner") \
        .select("case_id", (F.col("x") * F.col("n_notes")).alias("x"))
