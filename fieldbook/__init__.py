"""fieldbook: survey-and-audit analytics on Spark DataFrames.

Sub-packages
------------
sources    loading the driver tables, the survey role tables, CSV/Parquet I/O, views
functions  column-expression helpers (case-insensitive LIKE, safe division, labels)
operators  reusable relational building blocks (joins, shares, pivots, ranks, fixes, checks)
plans      the survey jobs and the query registry used by ``__spark_entry__``
streaming  incremental versions of the batch aggregates

Typical use::

    from fieldbook import build_session, survey_tables, register_survey_views
    from fieldbook.plans import survey, audit, planning

    spark = build_session()
    t = survey_tables(spark, "/data/survey")
    survey.queue_pivot(t.visits).show()
    audit.suspects(audit.incorrect_table(t)).show()
    register_survey_views(spark, "/data/survey")
    spark.sql("SELECT town_name, COUNT(*) FROM location GROUP BY 1").show()
"""

from fieldbook.plans.registry import oracle_sql, queries
from fieldbook.session import build_session, prepare
from fieldbook.sources.roles import register_survey_views, survey_tables

__all__ = ["build_session", "prepare", "survey_tables", "register_survey_views", "queries", "oracle_sql"]
