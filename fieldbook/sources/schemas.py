"""Declared table schemas (S-5) and their column bounds (C-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# MySQL's default collations compare text without case.
IGNORE_CASE = "UTF8_LCASE"


def collated(df: DataFrame, *cols: str, collation: str = IGNORE_CASE) -> DataFrame:
    """``df`` with text columns (default: all) under a collation that ignores case (M-2).

    Joins, groups, DISTINCT, IN and ``=`` on these columns then ignore case, whichever operator
    uses them; values keep their spelling.  A group shows one of its spellings.
    """
    names = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.collate(F.col(c), collation) for c in names})

AUDITOR_REPORT = T.StructType([
    T.StructField("location_id", T.StringType(), True),
    T.StructField("type_of_water_source", T.StringType(), True),
    T.StructField("true_water_source_score", T.IntegerType(), True),
    T.StructField("statements", T.StringType(), True),
])
AUDITOR_REPORT_LENGTHS = {"location_id": 32, "type_of_water_source": 64, "statements": 255}

PROJECT_PROGRESS = T.StructType([
    T.StructField("Project_id", T.LongType(), False),
    T.StructField("source_id", T.StringType(), False),
    T.StructField("Address", T.StringType(), True),
    T.StructField("Town", T.StringType(), True),
    T.StructField("Province", T.StringType(), True),
    T.StructField("Source_type", T.StringType(), True),
    T.StructField("Improvement", T.StringType(), True),
    T.StructField("Source_status", T.StringType(), True),
    T.StructField("Date_of_completion", T.DateType(), True),
    T.StructField("Comments", T.StringType(), True),
])
PROJECT_PROGRESS_LENGTHS = {"source_id": 20, "Address": 50, "Town": 30, "Province": 30,
                            "Source_type": 50, "Improvement": 50, "Source_status": 50}
PROJECT_PROGRESS_DEFAULTS = {"Source_status": "Backlog", "Date_of_completion": None, "Comments": None}
PROJECT_PROGRESS_NOT_NULL = ("Project_id", "source_id")

QUEUE_PIVOT_COLUMNS = ("hour_of_day", "sunday", "monday", "tuesday", "wednesday",
                       "thursday", "friday", "saturday")
