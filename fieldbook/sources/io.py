"""Reading and writing tables, views and materialised results (S-3, S-4, S-6..S-10)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.sources.store import TableStore, current_store, exists, move_files


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Import a CSV file with a header into a declared schema (S-3); no inference."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Export a result with a header line (S-4).

    ``single_file`` is for small final reports only (one writer task);
    large results keep their partitions.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder, removed with the current owner."""
    return current_store(spark).path(name)


def snapshot(df: DataFrame, name: str, store: TableStore | None = None) -> DataFrame:
    """``CREATE TABLE name AS SELECT ..`` (S-6): write once, return the stored copy.

    The copy lives in the shared checkpoint folder, so it survives executor
    loss and its lineage is cut.  ``store`` owns it (default: the current owner).
    """
    return (store or current_store(df.sparkSession)).store(df, name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW name`` (S-7): a lazy, re-evaluated view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_view(spark: SparkSession, name: str) -> bool:
    """``DROP VIEW IF EXISTS name`` (S-8)."""
    return spark.catalog.dropTempView(name)


def materialise(df: DataFrame, name: str, store: TableStore | None = None) -> DataFrame:
    """``CREATE TEMPORARY TABLE name AS ..`` read several times (S-9).

    Kept in executor memory, spilling to disk, and registered as a view until its owner gives it back.
    """
    return (store or current_store(df.sparkSession)).keep(df, name)


def append_with_defaults(df: DataFrame, schema: T.StructType, defaults: Mapping[str, object],
                         id_column: str | None = None, id_start: int = 1) -> DataFrame:
    """``INSERT INTO t (subset) SELECT ..`` (S-10): unlisted columns take their defaults.

    ``id_column`` gets a unique surrogate id (``SERIAL``) starting at
    ``id_start``: unique and increasing per partition, not gap-free; it needs
    no global ordering or single-partition step.
    """
    cols = []
    for field in schema.fields:
        if field.name in df.columns:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.name == id_column:
            new_id = F.lit(id_start).cast("long") + F.monotonically_increasing_id()
            cols.append(new_id.cast(field.dataType).alias(field.name))
        else:
            value = defaults.get(field.name)
            cols.append(F.lit(value).cast(field.dataType).alias(field.name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append (or overwrite) rows into a Parquet table."""
    df.write.mode(mode).parquet(path)


def broken_counts(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with a metric per rule that counts the rows breaking it, filled by the action that runs ``df``."""
    seen = Observation()
    return df.observe(seen, *[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]), seen


def insert_into(df: DataFrame, path: str, schema: T.StructType, defaults: Mapping[str, object],
                id_column: str | None = None, check=None, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """``INSERT INTO table (subset) SELECT ..`` against a Parquet table at ``path`` (S-10).

    A ``SERIAL`` id continues after the largest id already stored (one scalar
    aggregate over that column), so ids stay unique across inserts.  The rows are
    computed and written once, into a staging folder; ``rules`` (a predicate per
    declared constraint, true for a broken row) are counted by that same write.  A broken
    rule removes the staged rows and stops the insert before the table is touched;
    otherwise the staged files are moved into it, and the returned frame reads exactly
    these.  ``check`` maps the staged rows to violations that no predicate can express, in a pass of its own.
    Two inserts that run at the same time into one table need a lock around them.
    """
    spark = df.sparkSession
    store = current_store(spark)
    start = 1
    if id_column and exists(spark, path):
        current = spark.read.parquet(path).agg(F.max(id_column)).first()[0]
        start = (current or 0) + 1
    rows, seen = append_with_defaults(df, schema, defaults, id_column, start), None
    if rules:
        rows, seen = broken_counts(rows, rules)
    staged = store.store(rows, "insert")
    try:
        broken = {name: n for name, n in seen.get.items() if n} if seen else {}
        if check is not None and not check(staged).isEmpty():
            broken["check"] = check(staged).count()
        if broken:
            raise ValueError(f"rows for {path} break a declared constraint: {broken}")
        files = move_files(spark, staged._fb_path, path)
    finally:
        store.release(staged)
    return spark.read.schema(staged.schema).parquet(*files)


def write_sorted(df: DataFrame, path: str) -> None:
    """Write an ordered result (``orderBy``) so that its order can be read back.

    The sort is a range exchange; its partitions are written as files whose names ascend with
    the order, each sorted inside.  Nothing passes through one task.
    """
    df.write.mode("errorifexists").parquet(path)


def read_sorted(spark: SparkSession, path: str) -> DataFrame:
    """The rows of :func:`write_sorted` with ``file_place`` and ``row_place``, whose order is the stored one."""
    meta = F.col("_metadata.file_name")
    rows = spark.read.parquet(path)
    return rows.select("*", F.regexp_extract(meta, r"part-(\d+)", 1).cast("int").alias("file_place"),
                       F.expr("_metadata.row_index").alias("row_place"))
