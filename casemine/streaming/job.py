"""The streaming word-count job: message lines -> words -> counts per pane ->
idempotent keyed log (read back as sliding windows) and/or the console.

    python -m casemine.streaming.job --source kafka --brokers b:9092 --topic t \
        --out /shared/counts --checkpoint /shared/ckpt/counts
    python -m casemine.streaming.job --source files --path /data/events --out ... --checkpoint ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from .. import config as C
from ..session import get_session
from ..sources.streams import file_stream, kafka_lines
from . import sinks as SK
from . import windows as W


def counts_log(path: str) -> SK.KeyedLog:
    """The log of pane counts; ``W.windows_of`` turns its rows into windows."""
    return SK.KeyedLog(path, W.PANE_KEYS, W.PANE_SCHEMA, fold=SK.added)


def run_counts(lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, console: bool = False,
               compact_every: int = 100, partitions: int | None = None, keep_versions: int = 2):
    """Start counting ``lines`` (ts, value); returns the query.  Every
    ``compact_every`` batches the finished ones are folded into a snapshot; the
    files of the last ``keep_versions`` stay for readers that opened them."""
    log = counts_log(out)

    def write(batch: DataFrame, batch_id: int) -> None:
        panes = W.pane_counts(W.words(batch))
        if partitions:
            panes = panes.coalesce(partitions)
        if console:
            panes = panes.persist()
            SK.console_batch(W.windows_of(panes), batch_id)
        log.write(panes, batch_id)
        if console:
            panes.unpersist()
        if compact_every and batch_id and batch_id % compact_every == 0:
            log.compact(batch.sparkSession, batch_id - 1, keep_versions)  # this batch may still be replayed

    return (lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--source", choices=["kafka", "files"], default="kafka")
    ap.add_argument("--brokers")
    ap.add_argument("--topic")
    ap.add_argument("--group-id")
    ap.add_argument("--starting", default="earliest", help="starting offsets of a new query")
    ap.add_argument("--skip-lost-offsets", action="store_true",
                    help="go on when offsets are gone from the topic instead of failing")
    ap.add_argument("--path", help="event parquet table (ts, event_type)")
    ap.add_argument("--files-per-trigger", type=int)
    ap.add_argument("--out", required=True)
    ap.add_argument("--checkpoint", required=True)
    ap.add_argument("--trigger", default=C.STREAM_TRIGGER)
    ap.add_argument("--partitions", type=int, default=C.STREAM_PARTITIONS, help="files a batch writes")
    ap.add_argument("--compact-every", type=int, default=100, help="batches between snapshots, 0 for none")
    ap.add_argument("--keep-versions", type=int, default=2, help="versions whose files stay for their readers")
    ap.add_argument("--console", action="store_true")
    ap.add_argument("--once", action="store_true", help="process what is available and stop")
    a = ap.parse_args()
    spark = get_session(app="casemine-stream")
    if a.source == "kafka":
        lines = kafka_lines(spark, a.brokers, a.topic, a.starting, a.group_id,
                            fail_on_data_loss=not a.skip_lost_offsets).select("ts", "value")
    else:
        lines = W.event_lines(file_stream(spark, a.path, spark.read.parquet(a.path), a.files_per_trigger))
    trigger = {"availableNow": True} if a.once else {"processingTime": a.trigger}
    run_counts(lines, a.out, a.checkpoint, trigger, a.console, a.compact_every, a.partitions,
               a.keep_versions).awaitTermination()


if __name__ == "__main__":
    main()
