"""Terms found inside lines, as substrings, without comparing every term with
every line.

Lines are kept once each and read as windows: the up to ``GRAM`` characters that
start at each of their places.  A substring of at most ``GRAM`` characters is a
prefix of a window, so terms of that length are answered by the best score of
every prefix that is a term.  A longer term can only lie in lines that have all
its windows: it asks for the rarest of them (an equi-join on the window) and the
lines found are verified with ``contains``.

Most prefixes and windows of lines are no term's.  A bitmap of what the terms
ask for (one bit per hash value, ``BITS`` of them, so its size is fixed) is
broadcast, and only what it lets through is shuffled; what passes by chance
meets no term afterwards.  The index is dealt over tasks where a window is in very
many lines (the counts that choose the rarest window tell which); every other
join has a unique key on one side.  No row is dropped: a term with only common
windows takes more candidates.

Edge cases: null lines and null or empty terms give no row; repeated lines
count once, with their best score; characters are code points; a line may be a
whole text, as its windows are cut from an array of characters.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .skew import salted_join

GRAM = 8
CHUNK = 64   # places of a line that are read together
BITS = 24  # 2 MB in at most 2^18 words of 64 bits


def windows(text: str, size: int = GRAM, whole: bool = False) -> Column:
    """The distinct windows of a short text: the ``size`` characters from each
    place on, fewer at its end (none of those if ``whole``)."""
    last = F.length(text) - (size - 1 if whole else 0)
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))


def chunks(lines: DataFrame, size: int) -> DataFrame:
    """``lines`` with a row per ``CHUNK`` places of a line: the ``chunk`` that
    the windows from these places lie in (finding a place in a text takes time
    in proportion to the text before it)."""
    starts = F.sequence(F.lit(1), F.greatest(F.length("line"), F.lit(1)), F.lit(CHUNK))
    cut = F.transform(starts, lambda i: F.substring("line", i, F.lit(CHUNK + size - 1)))
    return lines.select(*[c for c in lines.columns if c != "line"], F.explode(cut).alias("chunk"))


def _place(text: str) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(1 << BITS))


def asked_for(rows: DataFrame, text: str, asked: DataFrame, by: str) -> DataFrame:
    """The rows whose ``text`` may be among ``asked``.``by``: those whose hash
    value is set in a bitmap of fixed size."""
    bits = asked.select(_place(by).alias("_h")).groupBy(F.expr("_h div 64").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(_h % 64 as int)))").alias("_bits"))
    met = rows.withColumn("_h", _place(text)).withColumn("_word", F.expr("_h div 64")).join(F.broadcast(bits), "_word")
    return met.where("shiftright(_bits, cast(_h % 64 as int)) & 1 = 1").drop("_h", "_word", "_bits")


def _buckets(counts: DataFrame, spark) -> dict[str, int]:
    """Windows with more than a quarter of a task's share of the index, and the
    number of tasks they are dealt over (at most 4 windows a task)."""
    p = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("lines")).first()[0] or 0
    hot = counts.where(F.col("lines") * 4 * p > total).select("gram", "lines").collect()
    return {r["gram"]: math.ceil(r["lines"] * p / total) for r in hot}


def contained_scores(terms: DataFrame, lines: DataFrame, size: int = GRAM) -> DataFrame:
    """(term, kind, score) of every term of ``terms`` (term, no term twice) that
    lies in at least one of ``lines`` (kind, line, score): the best score of those
    lines, for each kind of lines."""
    spark = terms.sparkSession
    ensure_checkpoint_dir(spark)
    terms = terms.where(F.length("term") > 0).select("term")
    once = (lines.where(F.col("line").isNotNull()).groupBy("kind", "line").agg(F.max("score").alias("score"))
            .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))  # few bytes, much work
            .withColumn("line_id", F.monotonically_increasing_id()).checkpoint(eager=True))
    parts = chunks(once, size).where(F.length("chunk") > 0)
    places = F.least(F.length("chunk"), F.lit(CHUNK))

    # terms that are prefixes of windows
    short = terms.where(F.length("term") <= size)
    least = short.agg(F.min(F.length("term"))).first()[0] or 1
    each = parts.select("kind", "score", "chunk", F.explode(F.sequence(F.lit(1), places)).alias("_at"))
    each = each.select("kind", "score", F.expr(f"substring(chunk, _at, {size})").alias("gram")).where(
        F.length("gram") >= least)
    each = each.select("kind", "score", "gram", F.explode(F.sequence(F.lit(least), F.length("gram"))).alias("_n"))
    seen = asked_for(each.select("kind", "score", F.expr("substring(gram, 1, _n)").alias("term")), "term", short, "term")
    found = seen.groupBy("term", "kind").agg(F.max("score").alias("score")).join(short, "term").select("term", "kind", "score")

    # longer ones: the lines of their rarest window; none if a window is in no line
    asked = terms.where(F.length("term") > size).select("term", F.explode(windows("term", size, whole=True)).alias("gram"))
    each = parts.where(F.length("chunk") >= size).select("line_id", "chunk", F.explode(F.sequence(
        F.lit(1), F.least(places, F.length("chunk") - (size - 1)))).alias("_at"))
    grams = each.select("line_id", F.expr(f"substring(chunk, _at, {size})").alias("gram"))
    index = asked_for(grams, "gram", asked, "gram").distinct().checkpoint(eager=True)
    counts = index.groupBy("gram").agg(F.count(F.lit(1)).alias("lines")).checkpoint(eager=True)
    rarest = (asked.join(counts, "gram", "left").groupBy("term")
              .agg(F.min(F.struct(F.coalesce("lines", F.lit(0)).alias("lines"), "gram")).alias("r"))
              .where("r.lines > 0").select("term", F.col("r.gram").alias("gram")))
    candidates = salted_join(index, rarest, "gram", hot=_buckets(counts, spark))
    verified = (candidates.select("term", "line_id").join(once, "line_id").where(F.col("line").contains(F.col("term")))
                .groupBy("term", "kind").agg(F.max("score").alias("score")))
    return found.unionByName(verified)
