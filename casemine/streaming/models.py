"""Versions of a model that scores a stream.

A model is two tables (classes, term log probabilities) in a folder of its own;
a version appears with one rename of a finished folder, so a reader sees all of it
or none.  Each micro-batch of a stream takes the newest version and pins it: a
replayed batch is scored by the version that scored it first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class ModelVersions:
    def __init__(self, path: str):
        self.path = path

    def _fs(self, spark: SparkSession):
        path = spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(spark._jsc.hadoopConfiguration()), path

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        fs, path = self._fs(spark)
        at = path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def versions(self, spark: SparkSession) -> list[int]:
        return sorted(int(n[1:]) for n in self._names(spark, "models") if n.startswith("v"))

    def publish(self, spark: SparkSession, classes: DataFrame, probs: DataFrame) -> int:
        """Write a model and make it the newest version; returns its number."""
        fs, path = self._fs(spark)
        made = f"{self.path}/written/{uuid.uuid4().hex}"
        classes.write.parquet(f"{made}/classes")
        probs.write.parquet(f"{made}/probs")
        fs.mkdirs(path(f"{self.path}/models"))
        while True:  # another writer may take the number first
            version = max(self.versions(spark), default=0) + 1
            if fs.rename(path(made), path(f"{self.path}/models/v{version}")):
                return version

    def load(self, spark: SparkSession, version: int) -> tuple[DataFrame, DataFrame]:
        at = f"{self.path}/models/v{version}"
        return spark.read.parquet(f"{at}/classes"), spark.read.parquet(f"{at}/probs")

    def pinned(self, spark: SparkSession, batch_id: int, name: str = "stream") -> int:
        """The version that scores a batch of a stream: the newest, the first time."""
        fs, path = self._fs(spark)
        pins = [n.split("-") for n in self._names(spark, f"pins/{name}")]
        for batch, version in pins:
            if int(batch) == batch_id:
                return int(version)
        known = self.versions(spark)
        if not known:
            raise ValueError("no model is published")
        fs.create(path(f"{self.path}/pins/{name}/{batch_id}-{known[-1]}")).close()
        return known[-1]
