"""The survey's relational tables, derived from the driver tables.

The reference works on a survey database (``location``, ``visits``,
``water_source`` ...).  The driver ships TPC-H-like tables instead, so each
survey table is a deterministic projection of them (FIXTURES.md section 3).
The same expressions exist as SQL in :mod:`fieldbook.plans.roles_sql` for the
DuckDB oracle.

Every frame is lazy except ``visits``, whose per-location visit ordinal is
computed once with the skew-safe ordinal helper and stored as Parquet in the
shared folder: it is the survey's base fact table, read by most jobs.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.operators.ordered import row_number_within
from fieldbook.sources.io import snapshot
from fieldbook.sources.store import owned, session_store
from fieldbook.sources.tables import load

# Fixed values of the survey domain: the categories, labels and e-mail format the
# survey's results are written in; they must stay equal to the reference's.
SOURCE_TYPES = ("river", "shared_tap", "tap_in_home", "tap_in_home_broken", "well")
POLLUTION_RESULTS = ("Clean", "Contaminated: Biological", "Contaminated: Chemical")
STATUS_VALUES = ("Backlog", "In progress", "Complete")
EMAIL_DOMAIN = "@ndogowater.gov"

# Fixture mapping of part types to water-source types (FIXTURES.md section 3).
PART_TYPE_TO_SOURCE = {
    "ECONOMY": "river",
    "LARGE": "shared_tap",
    "MEDIUM": "tap_in_home",
    "PROMO": "tap_in_home_broken",
}


def row_count(spark: SparkSession, sf_dir: str, table: str) -> Column:
    """Rows of a driver table at this scale, as a scalar of the plan: visits cover all its keys."""
    return load(spark, sf_dir, table).agg(F.count(F.lit(1))).scalar()


def location(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = load(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = load(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("c_custkey").alias("location_id"),
                     F.col("c_name").alias("address"),
                     F.col("n_name").alias("town_name"),
                     F.col("r_name").alias("province_name"),
                     F.col("c_mktsegment").alias("location_type")))


def employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = load(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    key = F.col("s_suppkey")
    phone = F.concat(F.lit("+99"), F.lpad(key.cast("string"), 9, "0"),
                     F.when(key % 2 == 0, F.lit(" ")).otherwise(F.lit("")))
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .select(key.alias("assigned_employee_id"),
                     F.replace(F.col("s_name"), F.lit("#"), F.lit(" ")).alias("employee_name"),
                     phone.alias("phone_number"),
                     F.col("n_name").alias("town_name")))


def water_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part", ["p_partkey", "p_type", "p_size"])
    kind = F.lit("well")
    for part_type, source_type in reversed(list(PART_TYPE_TO_SOURCE.items())):
        kind = F.when(F.col("p_type") == part_type, F.lit(source_type)).otherwise(kind)
    return p.select(F.col("p_partkey").alias("source_id"),
                    kind.alias("type_of_water_source"),
                    (F.col("p_size") * 10).cast("int").alias("number_of_people_served"))


def well_pollution(spark: SparkSession, sf_dir: str, sources: DataFrame | None = None) -> DataFrame:
    ws = sources if sources is not None else water_source(spark, sf_dir)
    sid = F.col("source_id")
    r = sid % 5
    description = (F.when(r == 0, "Clean")
                    .when(r == 1, "Clean Bacteria: E. coli")
                    .when(r == 2, "Clean Bacteria: Giardia Lamblia")
                    .otherwise("Bacteria: Cholera"))
    results = (F.when(r < 4, "Clean")
                .when(sid % 2 == 0, "Contaminated: Chemical")
                .otherwise("Contaminated: Biological"))
    biological = F.when(r == 0, F.lit(0.0)).otherwise((sid % 7 + 1).cast("double") / F.lit(100.0))
    return (ws.filter(F.col("type_of_water_source") == "well")
              .select(sid, description.alias("description"), results.alias("results"),
                      biological.alias("biological")))


def visits_unnumbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    return e.select(F.col("event_id").alias("record_id"),
                    F.col("user_id").alias("location_id"),
                    (F.col("event_id") % row_count(spark, sf_dir, "part")).alias("source_id"),
                    F.col("ts").alias("time_of_record"),
                    F.floor("value").cast("int").alias("time_in_queue"),
                    (F.col("event_id") % row_count(spark, sf_dir, "supplier")).alias("assigned_employee_id"))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits with ``visit_count`` = ordinal of the visit at its location (first = 1).

    One location may hold a large share of all visits, so the ordinal is not a
    ``row_number`` window (one task per location) but the range-partitioned
    running count of :mod:`fieldbook.operators.ordered`.
    """
    with owned(spark):  # the range-partitioned copy is only read by the final write
        numbered = row_number_within(visits_unnumbered(spark, sf_dir), ["location_id"],
                                     ["time_of_record"], "visit_count", tiebreak=["record_id"])
        # stored once: every job reads it, and first-visit filters then reach the Parquet scan
        return snapshot(numbered.select("record_id", "location_id", "source_id", "time_of_record",
                                        "visit_count", "time_in_queue", "assigned_employee_id"),
                        "visits", session_store(spark))


def water_quality(visits_df: DataFrame) -> DataFrame:
    loc, emp, rid = F.col("location_id"), F.col("assigned_employee_id"), F.col("record_id")
    off = emp.isin(3, 7) | ((rid * 19) % 100 < 15)
    score = F.when(off, (loc + 3) % 10 + 1).otherwise(loc % 10 + 1).cast("int")
    return visits_df.select(rid, F.col("visit_count"), score.alias("subjective_quality_score"))


def auditor_report(spark: SparkSession, sf_dir: str, visits_df: DataFrame, sources: DataFrame) -> DataFrame:
    c = load(spark, sf_dir, "customer", ["c_custkey"]).filter(F.col("c_custkey") % 4 != 0)
    first = visits_df.filter(F.col("visit_count") == 1).select("location_id", "source_id")
    typed = first.join(sources.select("source_id", "type_of_water_source"), "source_id")
    key = F.col("c_custkey")
    return (c.join(typed, c.c_custkey == typed.location_id, "left")
             .select(key.alias("location_id"),
                     F.col("type_of_water_source"),
                     (key % 10 + 1).cast("int").alias("true_water_source_score"),
                     F.when(key % 3 == 0, F.lit("Villagers mentioned Cash exchange"))
                      .otherwise(F.lit("No concerns")).alias("statements")))


def global_water_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows per country (the reference counts countries as ``COUNT(*)/2``)."""
    n = load(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return (n.select(F.col("n_name").alias("name"),
                     ((F.col("n_nationkey") + 1).cast("double") * F.lit(0.5)).alias("pop_n"),
                     F.explode(F.array(F.lit(1), F.lit(2))).alias("_copy"))
             .drop("_copy"))


class SurveyTables:
    """The survey tables of one session and one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def _get(self, name: str, build) -> DataFrame:
        with self._lock:
            if name not in self._cache:
                self._cache[name] = build()
            return self._cache[name]

    @property
    def location(self) -> DataFrame:
        return self._get("location", lambda: location(self.spark, self.sf_dir))

    @property
    def employee(self) -> DataFrame:
        return self._get("employee", lambda: employee(self.spark, self.sf_dir))

    @property
    def water_source(self) -> DataFrame:
        return self._get("water_source", lambda: water_source(self.spark, self.sf_dir))

    @property
    def well_pollution(self) -> DataFrame:
        return self._get("well_pollution", lambda: well_pollution(self.spark, self.sf_dir, self.water_source))

    @property
    def visits(self) -> DataFrame:
        return self._get("visits", lambda: visits(self.spark, self.sf_dir))

    @property
    def water_quality(self) -> DataFrame:
        return self._get("water_quality", lambda: water_quality(self.visits))

    @property
    def auditor_report(self) -> DataFrame:
        return self._get("auditor_report",
                         lambda: auditor_report(self.spark, self.sf_dir, self.visits, self.water_source))

    @property
    def global_water_access(self) -> DataFrame:
        return self._get("global_water_access", lambda: global_water_access(self.spark, self.sf_dir))


_TABLES: dict[tuple[str, int, str], SurveyTables] = {}
_TABLES_LOCK = threading.Lock()


def survey_tables(spark: SparkSession, sf_dir: str) -> SurveyTables:
    """Per-session cache of the survey tables (the reference keeps them as stored tables)."""
    # application id changes with every SparkContext, so a restarted session never sees stale frames
    key = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode(), sf_dir)
    with _TABLES_LOCK:
        if key not in _TABLES:
            _TABLES[key] = SurveyTables(spark, sf_dir)
        return _TABLES[key]


def forget_tables(spark: SparkSession) -> None:
    """Drop the session's survey tables with all it has stored; the next use reads the files anew."""
    app = (spark.sparkContext.applicationId, spark._jsparkSession.hashCode())
    with _TABLES_LOCK:
        for key in [k for k in _TABLES if k[:2] == app]:
            del _TABLES[key]
    session_store(spark).release_all()


SURVEY_VIEWS = ("location", "employee", "water_source", "well_pollution", "visits", "water_quality",
                "auditor_report", "global_water_access")


def register_survey_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Expose the survey tables as temp views, so SQL written against the survey schema runs as is.

    ``LIKE`` in Spark SQL is case-sensitive; write ``ILIKE`` where the
    survey queries relied on a case-insensitive collation (M-1).
    """
    t = survey_tables(spark, sf_dir)
    for name in SURVEY_VIEWS:
        getattr(t, name).createOrReplaceTempView(name)
    return list(SURVEY_VIEWS)


def data_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per column of every survey table: table, column, type, nullable (the data dictionary).

    Built from the schemas only (no data is read), so its size is the number
    of columns.
    """
    t = survey_tables(spark, sf_dir)
    rows = [(name, f.name, f.dataType.simpleString(), f.nullable)
            for name in SURVEY_VIEWS for f in getattr(t, name).schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, nullable boolean")
