"""Stream sources.

``kafka_lines`` reads message values as text lines with the record time
(brokers, topic and starting offsets are options; the Kafka connector must be
on the classpath).  ``file_lines`` replays a parquet table as a stream, which
is what tests and the bench use since no broker runs here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(brokers: str, topic: str, starting: str = "earliest", group_id: str | None = None,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": starting,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_lines(spark: SparkSession, brokers: str, topic: str, starting: str = "earliest",
                group_id: str | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """Message values as lines.  Offsets that are gone from the topic fail the
    query unless ``fail_on_data_loss`` is lifted."""
    raw = spark.readStream.format("kafka").options(
        **kafka_options(brokers, topic, starting, group_id, fail_on_data_loss)).load()
    return raw.select(F.col("timestamp").alias("ts"), F.col("value").cast("string").alias("value"),
                      "partition", "offset")


def kafka_write_options(brokers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def publish(df: DataFrame, brokers: str, topic: str) -> None:
    """Batch publish of (key, value) rows to a topic."""
    df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value") \
        .write.format("kafka").options(**kafka_write_options(brokers, topic)).save()


def file_stream(spark: SparkSession, path: str, like: DataFrame, max_files: int | None = None) -> DataFrame:
    """A parquet table (a file or a folder of part files) as a stream with the
    schema of ``like``."""
    r = spark.readStream.schema(like.schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if "*" not in path and fs.exists(at) and not fs.getFileStatus(at).isDirectory():
        # a stream watches folders: this one, for this name
        return r.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return r.parquet(path)
