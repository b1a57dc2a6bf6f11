"""Intermediate tables in the shared folder that the session names."""

from __future__ import annotations

import gc
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.session import checkpoint_dir


def dealt(keyed: DataFrame, *cols: str) -> DataFrame:
    """``keyed`` (one row per key) dealt by another hash than that of a join on ``cols``.

    Adaptive execution splits a hot key only where both sides of the join end in the join's own
    exchange, which an aggregate by the key would not need.
    """
    return keyed.repartition(F.xxhash64(*cols))


class Scratch:
    """Parquet tables of one operator run, below ``spark.checkpoint.dir``.

    A stored table cuts the lineage: a lost executor costs a re-read, not a new
    computation, and numbers that depend on partitioning cannot change afterwards.
    ``drop`` removes a table that is no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stored_at = path
        return out

    def tidy(self) -> None:
        """Let the driver give back what earlier steps held.

        Plans, broadcasts and shuffle files that nobody refers to any more stay until the JVM happens to collect
        its garbage; a long job asks for that between its steps, which also lets Spark's cleaner remove the files.
        """
        gc.collect()
        pa.default_memory_pool().release_unused()
        self.spark._jvm.System.gc()

    def drop(self, *stored: DataFrame) -> None:
        for df in stored:
            self.remove(df._stored_at)

    def remove(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
