"""Stream equals batch; restart from the checkpoint; idempotent keyed sink."""

import os
import tempfile

from pyspark.sql import functions as F

from casemine.plans.registry import QUERIES, load_all
from casemine.sources import tables as S
from casemine.sources.streams import file_stream, kafka_options
from casemine.streaming import sinks as SK
from casemine.streaming import windows as W
from casemine.streaming.job import counts_log, run_counts


def batch_counts(events):
    return W.flatten(W.sliding_counts(W.words(W.event_lines(events))))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def summed(spark, out):
    return W.flatten(W.windows_of(counts_log(out).read(spark)))


def test_files_out_of_time_order_and_a_restart(spark, sf_dir):
    """The later half arrives first; the earlier half after a restart."""
    events = S.table(spark, sf_dir, "events")
    base = tempfile.mkdtemp(prefix="cm-stream-")
    src_dir = os.path.join(base, "src")
    cut = events.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    events.where(F.col("ts") >= cut).coalesce(1).write.parquet(os.path.join(src_dir, "a"))
    for part in ("a", "b"):
        if part == "b":
            assert 0 < sum(r["count"] for r in summed(spark, out).collect()) < 30 * events.count()
            events.where(F.col("ts") < cut).coalesce(1).write.parquet(os.path.join(src_dir, "b"))
        lines = W.event_lines(file_stream(spark, os.path.join(src_dir, "*"), events))
        run_counts(lines, out, ckpt).awaitTermination()
    got = rows(summed(spark, out))
    assert got == rows(batch_counts(events))
    assert sum(r[3] for r in got) == 30 * events.count()


def test_tables_that_are_folders(spark, sf_dir, tmp_path):
    """Queries on streams read folders of part files, over several batches."""
    load_all()
    for name in ("events", "documents", "conversations", "labels"):
        S.table(spark, sf_dir, name).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    for stream, batch in (("stream_window_word_counts", "window_word_counts"),
                          ("stream_note_window_word_counts", "note_window_word_counts"),
                          ("stream_nb_predictions", "nb_predictions")):
        assert rows(QUERIES[stream](spark, str(tmp_path))) == rows(QUERIES[batch](spark, sf_dir))
    events = S.table(spark, sf_dir, "events")
    lines = W.event_lines(file_stream(spark, f"{tmp_path}/events.parquet", events, max_files=1))
    run_counts(lines, f"{tmp_path}/out", f"{tmp_path}/ckpt", compact_every=0).awaitTermination()
    assert len(os.listdir(f"{tmp_path}/out/log")) >= 3
    before = rows(summed(spark, f"{tmp_path}/out"))
    assert before == rows(batch_counts(events))
    # compaction: results stay, old batches go
    log = counts_log(f"{tmp_path}/out")
    assert log.compact(spark, 1) == 1
    left = sorted(n for n in os.listdir(f"{tmp_path}/out/log") if n.startswith("batch_id"))
    assert left[0] == "batch_id=2" and rows(summed(spark, f"{tmp_path}/out")) == before
    assert log.compact(spark) == 2 and rows(summed(spark, f"{tmp_path}/out")) == before
    assert sorted(os.listdir(f"{tmp_path}/out/snapshots")) == ["through=2"]
    assert log.compact(spark) == 2


def test_keyed_log_is_idempotent(spark, tmp_path):
    log = SK.KeyedLog(str(tmp_path), ["k"], "k string, v long")
    assert log.read(spark).count() == 0 and log.compact(spark) == -1
    b0 = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v long")
    b1 = spark.createDataFrame([("a", 2)], "k string, v long")
    log.write(b0, 0)
    log.write(b1, 1)
    log.write(b1, 1)  # replay after a failure
    assert rows(log.read(spark)) == [("a", 2), ("b", 1)]
    log.compact(spark)
    log.write(spark.createDataFrame([("b", 5)], "k string, v long"), 2)
    assert rows(log.read(spark)) == [("a", 2), ("b", 5)]


def test_offset_ranges(spark):
    df = spark.createDataFrame([(0, 5), (0, 9), (1, 3)], "partition int, offset long")
    got = sorted(tuple(r) for r in SK.offset_ranges(df).collect())
    assert got == [(0, 5, 9, 2), (1, 3, 3, 1)]


def test_kafka_options():
    o = kafka_options("b1:9092", "cases", group_id="g")
    assert o["subscribe"] == "cases" and o["startingOffsets"] == "earliest"
    assert o["kafka.bootstrap.servers"] == "b1:9092" and o["kafka.group.id"] == "g"
    assert o["failOnDataLoss"] == "true"
    assert kafka_options("b", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_streaming_job_cli_files_once(spark, sf_dir):
    import subprocess
    import sys
    base = tempfile.mkdtemp(prefix="cm-stream-cli-")
    src = os.path.join(base, "events")
    events = S.table(spark, sf_dir, "events")
    events.coalesce(1).write.parquet(src)
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-m", "casemine.streaming.job", "--source", "files", "--path", src,
                    "--out", out, "--checkpoint", ckpt, "--once", "--console"],
                   cwd=repo, check=True, timeout=600, capture_output=True)
    assert rows(summed(spark, out)) == rows(batch_counts(events))


def test_a_reader_keeps_its_rows_through_compactions(spark, tmp_path):
    log = SK.KeyedLog(str(tmp_path), ["k"], "k string, v long", fold=SK.added)
    want = {}

    def write(i):
        log.write(spark.createDataFrame([("a", i), (f"k{i}", 1)], "k string, v long"), i)
        want["a"], want[f"k{i}"] = want.get("a", 0) + i, 1

    for i in range(3):
        write(i)
    opened = log.read(spark)  # version 0: the log alone
    before = dict(want)
    assert log.compact(spark, 1, keep=2) == 1 and log.versions(spark) == {0: -1, 1: 1}
    assert {r["k"]: r["v"] for r in opened.collect()} == before
    second = log.read(spark)  # version 1
    write(3)
    assert log.compact(spark, keep=2) == 3 and log.versions(spark) == {1: 1, 2: 3}
    assert {r["k"]: r["v"] for r in second.collect()} == before
    # every kept version leads to today's rows
    assert all({r["k"]: r["v"] for r in log.read(spark, v).collect()} == want for v in (None, 1, 2))
    assert sorted(os.listdir(tmp_path / "log")).count("batch_id=0") == 0  # only version 0 read it
    try:
        log.read(spark, 0)
        assert False
    except ValueError:
        pass


def test_a_snapshot_that_was_not_published_is_not_read(spark, tmp_path):
    log = SK.KeyedLog(str(tmp_path), ["k"], "k string, v long", fold=SK.added)
    log.write(spark.createDataFrame([("a", 1)], "k string, v long"), 0)
    # a writer died between the snapshot and the switch
    spark.createDataFrame([("a", 99, 0)], "k string, v long, batch_id long").write.parquet(f"{tmp_path}/snapshots/through=0")
    assert rows(log.read(spark)) == [("a", 1)]
    assert not log._publish(spark, 0, 0)  # the number is taken
    assert log.compact(spark) == 0 and rows(log.read(spark)) == [("a", 1)]


def test_processing_time_trigger(spark, sf_dir, tmp_path):
    import time
    events = S.table(spark, sf_dir, "events")
    src = str(tmp_path / "src")
    events.coalesce(1).write.parquet(src)
    q = run_counts(W.event_lines(file_stream(spark, src, events)), str(tmp_path / "out"), str(tmp_path / "ckpt"),
                   trigger={"processingTime": "1 second"})
    try:
        events.limit(7).coalesce(1).write.mode("append").parquet(src)  # while it runs
        q.processAllAvailable()
        assert q.isActive
        end = time.time() + 60
        while sum(r["count"] for r in counts_log(str(tmp_path / "out")).read(spark).collect()) < events.count() + 7:
            assert time.time() < end
            time.sleep(1)
    finally:
        q.stop()
    assert sum(r["count"] for r in counts_log(str(tmp_path / "out")).read(spark).collect()) == events.count() + 7


def test_two_versions_of_a_model(spark, tmp_path):
    from casemine.operators import classify as NB
    from casemine.streaming import scoring as SC
    from casemine.streaming.models import ModelVersions
    text = "case_id long, history string"
    cases = [(1, "router drops packets"), (2, "printer jams paper"), (3, "router router reboots"), (4, "paper tray printer")]
    tokens = spark.createDataFrame([(i, w) for i, h in cases for w in set(h.split())], "case_id long, token string")

    def fitted(labels):
        return NB.fit(tokens, spark.createDataFrame(labels, "case_id long, label long"), 8)

    models = ModelVersions(str(tmp_path / "models"))
    assert models.publish(spark, *fitted([(1, 10), (2, 20)])) == 1
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for i, part in enumerate((cases[:2], cases[2:])):
        if i:
            assert models.publish(spark, *fitted([(1, 11), (2, 22)])) == 2
        spark.createDataFrame(part, text).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(text).parquet(src)
        SC.run_versioned_scoring(stream, None, out, str(tmp_path / "ckpt"), models).awaitTermination()
    got = {r["case_id"]: (r["prediction"], r["version"]) for r in spark.read.parquet(out).collect()}
    assert got == {1: (10, 1), 2: (20, 1), 3: (11, 2), 4: (22, 2)}
    # the first batch again, after the second version: scored as it was
    SC.versioned_sink(out, None, models)(spark.createDataFrame(cases[:2], text), 0)
    assert {r["case_id"]: (r["prediction"], r["version"]) for r in spark.read.parquet(out).collect()} == got


def test_windows_are_added_up_without_moving_them(spark):
    """Panes at the ends of stretches, before the epoch, repeated and of null
    words give the sums of every window; what is shuffled are panes."""
    from collections import Counter
    from datetime import datetime, timedelta, timezone
    zero = datetime(1970, 1, 1, tzinfo=timezone.utc)
    panes = [(q, w, n) for q in (-31, -1, 0, 29, 30, 59, 60, 61, 600) for w, n in (("a", 2), (None, 1))] + [(60, "a", 5)]
    df = spark.createDataFrame([(zero + timedelta(seconds=10 * q), w, n) for q, w, n in panes], W.PANE_SCHEMA)
    got = W.windows_of(df)
    want = Counter()
    for q, w, n in panes:
        for j in range(30):
            want[(q - j) * 10, w] += n
    rows = got.selectExpr("unix_seconds(window.start) AS s", "unix_seconds(window.end) AS e", "word", "count").collect()
    assert {(r["s"], r["word"]): r["count"] for r in rows} == dict(want) and len(rows) == len(want)
    assert all(r["e"] - r["s"] == 300 for r in rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("Generate explode") > plan.index("Exchange") > plan.index("Generate explode")
