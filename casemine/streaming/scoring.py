"""Clean new cases on a stream and match them to classes with a fitted naive
Bayes model.

A case arrives whole in one row, so it is cleaned and scored inside its
micro-batch with the batch DataFrame API (``foreachBatch``); the batch's tokens
are kept while the scoring joins read them.  The output goes to the partition
``batch_id=<id>`` with dynamic overwrite (a replayed batch replaces its own
output).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import classify as NB
from ..operators import tokens as TK
from .models import ModelVersions


def _put(pred: DataFrame, batch_id: int, path: str) -> None:
    (pred.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def _score(batch: DataFrame, notes: DataFrame | None, classes: DataFrame, probs: DataFrame, values: list, put) -> None:
    cases = batch.persist()
    tokens = TK.clean_tokens(cases, notes).persist()
    put(NB.predict_cases(tokens, classes, probs, values, cases))
    tokens.unpersist()
    cases.unpersist()


def prediction_sink(path: str, notes: DataFrame | None, classes: DataFrame, probs: DataFrame):
    values = NB.class_list(classes)

    def write(batch: DataFrame, batch_id: int) -> None:
        _score(batch, notes, classes, probs, values, lambda pred: _put(pred, batch_id, path))
    return write


def versioned_sink(path: str, notes: DataFrame | None, models: ModelVersions, name: str = "stream"):
    """A sink that scores each batch by the newest model: (case_id, prediction,
    version).  ``name`` tells streams that share the models apart."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = models.pinned(spark, batch_id, name)
        classes, probs = models.load(spark, version)
        _score(batch, notes, classes, probs, NB.class_list(classes),
               lambda pred: _put(pred.withColumn("version", F.lit(version)), batch_id, path))
    return write


def run_scoring(cases_stream: DataFrame, notes: DataFrame | None, path: str, checkpoint: str,
                classes: DataFrame, probs: DataFrame, trigger: dict | None = None):
    """Score cases (case_id, history) as they arrive."""
    return (cases_stream.writeStream
            .foreachBatch(prediction_sink(path, notes, classes, probs))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start())


def run_versioned_scoring(cases_stream: DataFrame, notes: DataFrame | None, path: str, checkpoint: str,
                          models: ModelVersions, name: str = "stream", trigger: dict | None = None):
    """The same with a model that may change while the stream runs."""
    return (cases_stream.writeStream
            .foreachBatch(versioned_sink(path, notes, models, name))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start())
