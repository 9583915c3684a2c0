"""Spark session helpers.

The library never hard-codes a master or a scratch folder.  On a cluster the
session comes configured (master, ``spark.checkpoint.dir`` on shared storage);
``get_session`` only fills in what is unset, which is what tests and the bench
rely on.
"""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package wants, applied when the session is built.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Kryo for shuffled JVM objects (GraphX messages of EM LDA, ML vectors)
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # streaming state on local disk of the executors (RocksDB), not the JVM heap;
    # changelog checkpointing uploads only the changes per micro-batch
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(app: str = "casemine", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session or build one with the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not value:
        value = spark.conf.get("spark.checkpoint.dir", None)
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured ``spark.checkpoint.dir``; only when it is unset and
    the master is ``local`` (tests) create a private folder for this process.
    Any other master must name a folder that all its machines share."""
    value = checkpoint_dir(spark)
    if value is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir is unset; name a shared folder for master {master}")
        value = tempfile.mkdtemp(prefix="casemine-ckpt-")
        spark.conf.set("spark.checkpoint.dir", value)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(value)
    return value


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clean_shuffles(rdd) -> None:
    """Delete what the shuffles below an RDD wrote, down to persisted or
    checkpointed ones; called when what was made of it is stored."""
    rdd._jrdd.rdd().cleanShuffleDependencies(True)


def collect_garbage(spark: SparkSession) -> None:
    """Have Spark delete the shuffles and checkpoints of frames that nothing
    refers to any more; it does so only when the driver's JVM collects garbage."""
    gc.collect()
    spark._jvm.System.gc()
