"""Queue analyses over a stream of arriving visit files.

State is one row per group key (24 hour labels, 7 weekdays), so the
complete-mode aggregation keeps bounded state whatever the input volume.
Checkpoints go under the session's shared checkpoint folder.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldbook.functions.exprs import weekday_name
from fieldbook.plans.survey import queue_by, queue_pivot
from fieldbook.session import checkpoint_dir


def visit_stream(spark: SparkSession, events_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Arriving event files projected to the visit columns the queue analyses read.

    ``events_path`` is normally a folder new files land in; a single file is accepted too.
    """
    from pyspark.sql import functions as F

    schema = spark.read.parquet(events_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a single file (as in the test data) is watched through a glob, since a
    # plain file stream source expects a folder
    source = events_path if os.path.isdir(events_path) else events_path + "*"
    e = reader.parquet(source)
    return e.select(F.col("event_id").alias("record_id"),
                    F.col("user_id").alias("location_id"),
                    F.col("ts").alias("time_of_record"),
                    F.floor("value").cast("int").alias("time_in_queue"))


def _start(df: DataFrame, name: str, sink: str, available_now: bool, every: str = "10 seconds") -> StreamingQuery:
    # one folder per query name: a restart under the same shared folder resumes where the query stopped
    location = os.path.join(checkpoint_dir(df.sparkSession), "streams", name)
    writer = (df.writeStream.outputMode("complete").format(sink).queryName(name)
                .option("checkpointLocation", location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()


def start_queue_pivot(spark: SparkSession, events_path: str, name: str = "queue_pivot_live",
                      sink: str = "memory", available_now: bool = True, every: str = "10 seconds",
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """K-12 kept current: hour label x weekday average non-zero queue."""
    stream = visit_stream(spark, events_path, max_files_per_trigger)
    return _start(queue_pivot(stream), name, sink, available_now, every)


def start_queue_by_weekday(spark: SparkSession, events_path: str, name: str = "queue_by_weekday_live",
                           sink: str = "memory", available_now: bool = True) -> StreamingQuery:
    """K-11 kept current: average non-zero queue per weekday."""
    v = visit_stream(spark, events_path)
    return _start(queue_by(v, weekday_name("time_of_record").alias("day_of_week")), name, sink, available_now)
