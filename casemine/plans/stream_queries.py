"""Streaming queries: sliding-window word counts as a batch plan and as a
Structured Streaming query (replayed from the events or conversations table)
whose summed log must equal the batch result."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import tables as S
from ..sources.streams import file_stream
from ..streaming import arrival as A
from ..streaming import windows as W
from ..streaming.job import counts_log, run_counts
from .registry import query

_SLIDE_US = 10_000_000
_N_WINDOWS = 30  # 5 minutes / 10 seconds


def _window_sql(words: str) -> str:
    """Every word of a line in every window that covers its time."""
    return f"""
WITH w AS ({words}),
x AS (SELECT word, make_timestamp(((epoch_us(ts) // {_SLIDE_US}) - k) * {_SLIDE_US}) AS window_start
      FROM w, range(0, {_N_WINDOWS}) r(k))
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, word, count(*) AS count
FROM x GROUP BY window_start, word
"""


_EVENTS_SQL = _window_sql("SELECT ts, unnest(string_split(event_type, ' ')) AS word FROM events")
_NOTES_SQL = _window_sql("SELECT make_timestamp((conv_id * 60 + turn * 10) * 1000000) AS ts, "
                         "unnest(string_split(text, ' ')) AS word FROM conversations")


def _streamed(spark, sf_dir, name: str, to_lines):
    """Replay a table (one file or a folder of part files) through the stream
    and read the summed log back as windows."""
    source = file_stream(spark, os.path.join(sf_dir, f"{name}.parquet"), S.table(spark, sf_dir, name))
    run_id = uuid.uuid4().hex[:12]
    out = scratch_path(spark, f"window_counts_{run_id}")
    run_counts(to_lines(source), out, scratch_path(spark, f"window_counts_ckpt_{run_id}")).awaitTermination()
    return W.flatten(W.windows_of(counts_log(out).read(spark)))


@query("window_word_counts", _EVENTS_SQL)
def window_word_counts(spark, sf_dir):
    return W.flatten(W.sliding_counts(W.words(W.event_lines(S.table(spark, sf_dir, "events")))))


@query("stream_window_word_counts", _EVENTS_SQL)
def stream_window_word_counts(spark, sf_dir):
    return _streamed(spark, sf_dir, "events", W.event_lines)


@query("note_window_word_counts", _NOTES_SQL)
def note_window_word_counts(spark, sf_dir):
    """Lines of several words: the turns of conversations."""
    return W.flatten(W.sliding_counts(W.words(W.note_lines(S.table(spark, sf_dir, "conversations")))))


@query("stream_note_window_word_counts", _NOTES_SQL)
def stream_note_window_word_counts(spark, sf_dir):
    return _streamed(spark, sf_dir, "conversations", W.note_lines)


# every word at each pane in which one of its panes comes or leaves, zeros kept;
# the count by its definition: the words of the 30 panes up to this one
_ARRIVAL_SQL = f"""
WITH p AS (SELECT epoch_us(ts) // {_SLIDE_US} AS pane, unnest(string_split(event_type, ' ')) AS word FROM events),
t AS (SELECT pane, word FROM p UNION SELECT pane + {_N_WINDOWS}, word FROM p),
n AS (SELECT pane, word, count(*) AS n FROM p GROUP BY ALL)
SELECT make_timestamp(t.pane * {_SLIDE_US}) AS pane, t.word, coalesce(sum(n.n), 0)::BIGINT AS count
FROM t LEFT JOIN n ON n.word = t.word AND n.pane > t.pane - {_N_WINDOWS} AND n.pane <= t.pane
WHERE t.pane <= (SELECT max(pane) FROM p) GROUP BY t.pane, t.word
"""


def _pane_times(rows):
    return rows.select(F.timestamp_seconds(F.col("pane") * A.SLIDE).cast("timestamp_ntz").alias("pane"), "word", "count")


@query("arrival_window_counts", _ARRIVAL_SQL)
def arrival_window_counts(spark, sf_dir):
    """Counts by arrival with words at zero kept; an event arrives at its time."""
    return _pane_times(A.arrival_counts(W.words(W.event_lines(S.table(spark, sf_dir, "events")))))


@query("stream_arrival_window_counts", _ARRIVAL_SQL)
def stream_arrival_window_counts(spark, sf_dir):
    """The same on a stream that adds what comes and takes off what leaves."""
    source = file_stream(spark, os.path.join(sf_dir, "events.parquet"), S.table(spark, sf_dir, "events"))
    run_id = uuid.uuid4().hex[:12]
    out = scratch_path(spark, f"arrival_counts_{run_id}")
    A.run_arrival(W.words(W.event_lines(source)), out, scratch_path(spark, f"arrival_ckpt_{run_id}")).awaitTermination()
    return _pane_times(A.ArrivalCounts(out).read(spark))
