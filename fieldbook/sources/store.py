"""Owners of stored tables (S-6, S-9): who wrote a table below the shared folder also removes it.

A :class:`TableStore` writes Parquet copies below ``spark.checkpoint.dir`` and keeps cached frames.
``release`` gives a table back, leaving the ``with owned(spark)`` block gives back all tables stored
inside it, and what a session still holds when its driver ends is removed by the file system's own
exit hook.  Stored copies are reliable (a lost executor costs a read, not a new computation).
"""

from __future__ import annotations

import contextlib
import os
import threading
import uuid
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from fieldbook.session import checkpoint_dir


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def move_files(spark: SparkSession, source: str, target: str) -> list[str]:
    """Move the data files of a finished write into the folder ``target``; returns their new names."""
    fs, folder = _file_system(spark, source)
    into = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(into)
    moved = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")):
            place = spark._jvm.org.apache.hadoop.fs.Path(into, name)
            if not fs.rename(status.getPath(), place):
                raise OSError(f"{name} could not be moved to {target}")
            moved.append(place.toString())
    return moved


class TableStore:
    """Stored tables and cached views of one owner."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._lock = threading.Lock()
        self._paths: set[str] = set()
        self._kept: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        """A fresh folder below the shared folder, removed with its owner.

        It is inside one that exists already, since only what exists can be marked for removal at exit.
        """
        outer = os.path.join(checkpoint_dir(self.spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")
        fs, target = _file_system(self.spark, outer)
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        path = os.path.join(outer, "rows")
        with self._lock:
            self._paths.add(path)
        return path

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the stored copy."""
        path = self.path(name)
        df.write.mode("errorifexists").parquet(path)
        copy = self.spark.read.schema(df.schema).parquet(path)
        copy._fb_path = path
        return copy

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Cache ``df`` in executor memory, spilling to disk, under a view name; a former one of that name goes."""
        cached = df.persist(StorageLevel.MEMORY_AND_DISK)
        cached.createOrReplaceTempView(name)
        with self._lock:
            former, self._kept[name] = self._kept.get(name), cached
        if former is not None and not former.sameSemantics(cached):
            former.unpersist()
        return cached

    def release(self, *tables: DataFrame | str) -> None:
        """Remove stored copies (or folders that ``path`` gave) that are no longer read."""
        for table in tables:
            path = table if isinstance(table, str) else table._fb_path
            with self._lock:
                self._paths.discard(path)
            fs, target = _file_system(self.spark, os.path.dirname(path))
            fs.delete(target, True)
            fs.cancelDeleteOnExit(target)

    def release_all(self) -> None:
        """Give back every table, cached frame and view of this owner."""
        with self._lock:
            kept, self._kept = self._kept, {}
            paths = list(self._paths)
        for name, frame in kept.items():
            frame.unpersist()
            self.spark.catalog.dropTempView(name)
        self.release(*paths)


_OWNERS: dict[tuple[str, int], list[TableStore]] = {}
_OWNERS_LOCK = threading.Lock()


def _owners(spark: SparkSession) -> list[TableStore]:
    # the application id changes with every context, so a restarted session has its own owners
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode())
    with _OWNERS_LOCK:
        return _OWNERS.setdefault(key, [TableStore(spark)])


def session_store(spark: SparkSession) -> TableStore:
    """The owner of tables that live as long as the session."""
    return _owners(spark)[0]


def current_store(spark: SparkSession) -> TableStore:
    """The owner of the innermost ``owned`` block; without one, the session's."""
    return _owners(spark)[-1]


@contextlib.contextmanager
def owned(spark: SparkSession) -> Iterator[TableStore]:
    """Tables that helpers store inside the block are removed when it ends: read their results before."""
    owners, mine = _owners(spark), TableStore(spark)
    owners.append(mine)
    try:
        yield mine
    finally:
        owners.remove(mine)
        mine.release_all()
