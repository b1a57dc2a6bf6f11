"""The streaming queue analyses end with the same numbers as the batch ones."""

from conftest import SF_SMALL
from fieldbook.plans import survey
from fieldbook.sources.roles import survey_tables
from fieldbook.streaming import queues


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_streaming_pivot_equals_batch(spark):
    q = queues.start_queue_pivot(spark, f"{SF_SMALL}/events.parquet", name="pivot_live_test")
    q.awaitTermination(300)
    live = spark.table("pivot_live_test")
    batch = survey.queue_pivot(survey_tables(spark, SF_SMALL).visits)
    assert live.columns == batch.columns
    assert _rows(live) == _rows(batch)


def test_streaming_weekday_average_equals_batch(spark):
    from fieldbook.functions.exprs import weekday_name

    q = queues.start_queue_by_weekday(spark, f"{SF_SMALL}/events.parquet", name="weekday_live_test")
    q.awaitTermination(300)
    v = survey_tables(spark, SF_SMALL).visits
    batch = survey.queue_by(v, weekday_name("time_of_record").alias("day_of_week"))
    assert _rows(spark.table("weekday_live_test")) == _rows(batch)


def test_pivot_follows_files_as_they_arrive(spark):
    import tempfile

    from pyspark.sql import functions as F

    src = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    watched = f"{tempfile.mkdtemp(prefix='fb-stream-')}/visits"
    src.filter(F.col("event_id") % 2 == 0).write.parquet(watched)
    q = queues.start_queue_pivot(spark, watched, name="pivot_arrivals", available_now=False, every="1 second")
    try:
        q.processAllAvailable()
        first = _rows(spark.table("pivot_arrivals"))
        even = survey.queue_pivot(_visits_of(src.filter(F.col("event_id") % 2 == 0)))
        assert first == _rows(even)
        # a second file lands in the watched folder: the state now covers both
        src.filter(F.col("event_id") % 2 == 1).write.mode("append").parquet(watched)
        q.processAllAvailable()
        assert _rows(spark.table("pivot_arrivals")) == _rows(survey.queue_pivot(_visits_of(src)))
    finally:
        q.stop()


def _visits_of(events):
    sources, employees = 200, 10
    from pyspark.sql import functions as F

    return events.select(F.col("event_id").alias("record_id"), F.col("user_id").alias("location_id"),
                         (F.col("event_id") % sources).alias("source_id"),
                         F.col("ts").alias("time_of_record"), F.floor("value").cast("int").alias("time_in_queue"))
