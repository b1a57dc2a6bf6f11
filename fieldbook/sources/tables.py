"""Scans of the driver tables (S-1) and previews (S-2)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NATIVE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def load(spark: SparkSession, sf_dir: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """Full scan of one table; a column list only narrows the projection.

    Column pruning and filter push-down happen in the Parquet scan because the
    frame stays lazy: later ``select``/``filter`` calls reach ``ReadSchema`` and
    ``PushedFilters``.
    """
    df = spark.read.parquet(table_path(sf_dir, table))
    return df.select(*columns) if columns else df


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows in no particular order (``LIMIT n`` without ``ORDER BY``)."""
    return df.limit(n)


def preview_size(df: DataFrame, n: int = 10) -> DataFrame:
    """Row count of a preview: the deterministic part of S-2."""
    return preview(df, n).agg(F.count(F.lit(1)).alias("preview_rows"))
