"""Spark session set-up shared by tests, the bench and the driver entry points.

Cluster settings come from the cluster; this module only fills gaps, so the
same code runs under ``spark-submit`` on a large cluster and on ``local[8]``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on for correct results (timestamps are formatted
# in UTC; MySQL-like NULL-on-divide is done explicitly with try_divide).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Defaults for scale: adaptive execution re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "fieldbook") -> SparkSession:
    """Create (or reuse) a session; on a cluster ``master`` stays None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("FIELDBOOK_DRIVER_MEMORY", "16g"))
    for key, value in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on, and make sure a checkpoint folder exists.

    The checkpoint folder is read from ``spark.checkpoint.dir`` (the shared
    folder a cluster names); a private one under the temp folder is created
    only when the session has none, which is the local/test case.
    """
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="fieldbook-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
