"""Sliding-window word counts from pane counts.

Lines are split on single spaces into words.  Words are counted once per pane
(the slide, 10 seconds) and word; a window (5 minutes) is the sum of the 30
panes it covers.  Pane counts are additive, so a stream only has to add up what
its micro-batches wrote: there is no state and no watermark, and no row is
dropped for being late.  Windows are event time (the original counted by arrival
time and kept zero counts; we emit no zero rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C

PANE_KEYS = ["pane", "word"]
PANE_SCHEMA = "pane timestamp, word string, count long"
STRETCH = 60  # slides whose windows are added up together


def event_lines(events: DataFrame) -> DataFrame:
    """(ts timestamp, value string): an event becomes a one-line message
    holding its type; the event time is cast from TIMESTAMP_NTZ."""
    return events.select(F.col("ts").cast("timestamp").alias("ts"),
                         F.col("event_type").alias("value"))


def note_lines(conversations: DataFrame) -> DataFrame:
    """(ts, value): a conversation turn as a message of several words.  Turns
    carry no time; conversation n starts n minutes after the epoch, with ten
    seconds a turn."""
    return conversations.select(
        F.timestamp_seconds(F.col("conv_id") * 60 + F.col("turn") * 10).alias("ts"), F.col("text").alias("value"))


def words(lines: DataFrame, value: str = "value", ts: str = "ts") -> DataFrame:
    return lines.select(F.col(ts).alias("ts"), F.explode(F.split(F.col(value), " ")).alias("word"))


def pane_counts(w: DataFrame, slide: str = C.STREAM_SLIDE) -> DataFrame:
    """(pane, word, count): words per slide interval, named by its start."""
    return w.groupBy(F.window("ts", slide).alias("_p"), "word").agg(F.count(F.lit(1)).alias("count")) \
        .select(F.col("_p.start").alias("pane"), "word", "count")


def _micros(interval: str) -> Column:
    return F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}"))


def windows_of(panes: DataFrame, window: str = C.STREAM_WINDOW, slide: str = C.STREAM_SLIDE) -> DataFrame:
    """(window, word, count): sum of the panes of every window that has any.
    Starts are cut into stretches of ``STRETCH`` slides; a word's panes are
    sent to the stretches that their windows start in (two at most while a
    window is no longer than a stretch) and added up there inside the row, so
    that panes are moved, not windows."""
    step, length = _micros(slide), _micros(window)
    width = step * F.lit(STRETCH)
    at = F.unix_micros("pane")
    first = at - length + step

    def stretch(t: Column) -> Column:
        return ((t - F.pmod(t, width)) / width).cast("long")

    dealt = panes.select("word", F.explode(F.sequence(stretch(first), stretch(at))).alias("stretch"),
                         first.alias("first"), at.alias("at"), "count").repartition("stretch", "word")
    # a pane that came in several batches is one entry, so lists are short
    once = dealt.groupBy("stretch", "word", "first", "at").agg(F.sum("count").alias("n"))
    lists = once.groupBy("stretch", "word").agg(F.collect_list(F.struct("first", "at", "n")).alias("ps"))
    starts = F.array_distinct(F.flatten(F.transform("ps", lambda p: F.filter(
        F.sequence(p["first"], p["at"], step), lambda t: stretch(t) == F.col("stretch")))))
    found = lists.select("word", "ps", F.explode(starts).alias("t"))
    n = F.aggregate("ps", F.lit(0).cast("long"), lambda a, p: a + F.when(
        F.col("t").between(p["first"], p["at"]) & (F.pmod(F.col("t") - p["first"], step) == 0), p["n"]).otherwise(0))
    start = F.timestamp_micros("t")
    return found.select(F.struct(start.alias("start"), (start + F.expr(f"INTERVAL {window}")).alias("end")).alias("window"),
                        "word", n.alias("count"))


def sliding_counts(w: DataFrame, window: str = C.STREAM_WINDOW, slide: str = C.STREAM_SLIDE) -> DataFrame:
    return windows_of(pane_counts(w, slide), window, slide)


def flatten(counts: DataFrame) -> DataFrame:
    """window_start, window_end (as TIMESTAMP_NTZ in the session zone), word, count."""
    return counts.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                         "word", "count")
