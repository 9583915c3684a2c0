"""Counts by arrival: added and taken off, zeros kept, over batches and a restart."""

import datetime as dt

from casemine.sources import tables as S
from casemine.streaming import arrival as A
from casemine.streaming import windows as W

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def rows(df):
    return sorted(tuple(r) for r in df.select("pane", "word", "count").collect())


def words(spark, panes):
    """A row per (pane, word)."""
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=10 * p + 3), w) for p, w in panes], "ts timestamp, word string")


def plain(panes, size):
    base = int(T0.timestamp()) // 10
    last = max(p for p, _ in panes)
    touched = {(p, w) for p, w in panes} | {(p + size, w) for p, w in panes}
    return sorted((base + p, w, sum(1 for q, v in panes if v == w and p - size < q <= p)) for p, w in touched if p <= last)


PANES = [(0, "a"), (0, "a"), (0, "b"), (1, "a"), (3, "c"), (4, "a"), (9, "b"), (9, "b"), (30, "c"), (31, "a")]


def test_batch_form(spark):
    got = rows(A.arrival_counts(words(spark, PANES), size=5))
    assert got == plain(PANES, 5)
    assert any(c == 0 for _, _, c in got)
    base = int(T0.timestamp()) // 10
    now = {r["word"]: r["count"] for r in A.as_of(A.arrival_counts(words(spark, PANES), size=5), base + 20).collect()}
    assert now == {"a": 0, "b": 0, "c": 0}  # all were seen, none came lately
    assert A.arrival_counts(words(spark, []).limit(0)).count() == 0


def test_batches_a_replay_and_a_restart(spark, tmp_path):
    cuts = [PANES[:3], PANES[3:5], [], PANES[5:8], PANES[8:]]
    for i, part in enumerate(cuts):
        # a new object per batch: all it knows is in the tables
        A.ArrivalCounts(str(tmp_path), size=5).write(words(spark, part) if part else words(spark, PANES).limit(0), i)
        if i in (1, 3):  # replayed after a failure
            A.ArrivalCounts(str(tmp_path), size=5).write(words(spark, part), i)
    got = A.ArrivalCounts(str(tmp_path), size=5)
    assert rows(got.read(spark)) == plain(PANES, 5)
    state = {r["word"]: r["count"] for r in got._read(spark, "state", got._batches(spark, "state")[-1:]).collect()}
    assert state == {"a": 1, "b": 0, "c": 1}


def test_a_pane_that_goes_on_and_a_late_date(spark, tmp_path):
    log = A.ArrivalCounts(str(tmp_path), size=5)
    log.write(words(spark, [(2, "a"), (2, "b")]), 0)
    log.write(words(spark, [(2, "a"), (0, "b"), (3, "a")]), 1)  # the row dated 0 arrives in pane 2
    assert rows(log.read(spark)) == plain([(2, "a"), (2, "b"), (2, "a"), (2, "b"), (3, "a")], 5)


def test_stream_over_files_in_order(spark, sf_dir, tmp_path):
    events = S.table(spark, sf_dir, "events").orderBy("ts")
    every = events.collect()
    third = len(every) // 3 + 1
    src = str(tmp_path / "src")
    for i in range(0, len(every), third):
        # one file per batch; a restart before each
        spark.createDataFrame(every[i:i + third], events.schema).coalesce(1).write.mode("append").parquet(src)
        lines = W.event_lines(spark.readStream.schema(events.schema).parquet(src))
        A.run_arrival(W.words(lines), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    log = A.ArrivalCounts(str(tmp_path / "out"))
    assert len(log._batches(spark, "rows")) == 3
    assert rows(log.read(spark)) == rows(A.arrival_counts(W.words(W.event_lines(events))))
