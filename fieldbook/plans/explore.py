"""First look at the survey tables: table sizes, lookups, queues and repeat visits (K-3, K-14, K-15, K-17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions.exprs import like_ci, round_int
from fieldbook.operators.relational import distinct_values, lookup_by, semi
from fieldbook.plans.registry import register
from fieldbook.sources.roles import SurveyTables, survey_tables

# ---------------------------------------------------------------- library functions


def lookup_by_address(t: SurveyTables, address_pattern: str) -> DataFrame:
    """K-3: the source serving the (single) location whose address matches, people rounded to hundreds.

    Two nested scalar subqueries (J-11); each must return at most one row.
    The visit lookup keeps the first visit so one location gives one source.
    """
    loc_id = t.location.filter(like_ci("address", address_pattern)).select("location_id")
    first = t.visits.filter(F.col("visit_count") == 1)
    src_id = lookup_by(first, "location_id", loc_id).select("source_id")
    ws = lookup_by(t.water_source, "source_id", src_id)
    return ws.select(F.col("type_of_water_source").alias("Type"),
                     F.round(F.col("number_of_people_served"), -2).cast("int").alias("Number_Served"))


def sources_by_queue(t: SurveyTables, predicate) -> DataFrame:
    """K-14: water sources having at least one visit whose queue satisfies ``predicate`` (J-9)."""
    return semi(t.water_source, t.visits.filter(predicate), "source_id")


def top_quality_repeats(t: SurveyTables, score: int = 10) -> DataFrame:
    """K-15: repeat visits (visit_count > 1) to sources with the top score, with visit and source."""
    wq = t.water_quality.filter((F.col("subjective_quality_score") == score) & (F.col("visit_count") > 1))
    v = t.visits.select("record_id", "location_id", "source_id", "time_of_record", "time_in_queue",
                        "assigned_employee_id", F.col("visit_count").alias("visit_visit_count"))
    return wq.join(v, "record_id").join(t.water_source, "source_id")


def population_of(gwa: DataFrame, name_pattern: str) -> DataFrame:
    """K-17: distinct population (thousands to people) of the countries whose name matches."""
    return distinct_values(gwa.filter(like_ci("name", name_pattern)),
                           F.round(F.col("pop_n") * F.lit(1000.0)).alias("population"))


def _t(spark, sf_dir) -> SurveyTables:
    return survey_tables(spark, sf_dir)


# ---------------------------------------------------------------- bindings

_TABLE_COUNTS = [("employee", "num_of_employees"), ("global_water_access", "num_of_country_records"),
                 ("location", "source_locations"), ("visits", "num_of_visits"),
                 ("water_quality", "num_of_quality_records"), ("water_source", "num_of_water_sources"),
                 ("well_pollution", "num_of_well_pollution_records")]


@register("a01_survey_table_counts", "SELECT " + ",\n".join(
    f"(SELECT COUNT(*) FROM {tbl}) AS {alias}" for tbl, alias in _TABLE_COUNTS))
def a01_survey_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    cols = [getattr(t, tbl).agg(F.count(F.lit(1))).scalar().alias(alias) for tbl, alias in _TABLE_COUNTS]
    return spark.range(1).select(*cols)


@register("k17_country_count", """
SELECT CAST(ROUND(COUNT(*) / 2) AS BIGINT) AS num_of_countries FROM global_water_access""")
def k17_country_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    gwa = _t(spark, sf_dir).global_water_access
    return gwa.agg(F.round(F.count(F.lit(1)) / F.lit(2)).cast("bigint").alias("num_of_countries"))


@register("k17_population_of", """
SELECT DISTINCT ROUND(pop_n * 1000) AS population FROM global_water_access WHERE name ILIKE '%nation_1%'""")
def k17_population_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population_of(_t(spark, sf_dir).global_water_access, "%nation_1%")


@register("k03_lookup_by_address", """
SELECT type_of_water_source AS "Type", CAST(ROUND(number_of_people_served, -2) AS INTEGER) AS Number_Served
FROM water_source
WHERE source_id = (SELECT source_id FROM visits
                   WHERE visit_count = 1
                     AND location_id = (SELECT location_id FROM location WHERE address ILIKE 'customer#000000018%'))""")
def k03_lookup_by_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_by_address(_t(spark, sf_dir), "customer#000000018%")


@register("k03_people_per_tap", """
SELECT type_of_water_source, source_id,
       CAST(ROUND(number_of_people_served / 6) AS INTEGER) AS households
FROM water_source WHERE type_of_water_source = 'tap_in_home'""")
def k03_people_per_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = _t(spark, sf_dir).water_source.filter(F.col("type_of_water_source") == "tap_in_home")
    return ws.select("type_of_water_source", "source_id",
                     round_int(F.col("number_of_people_served") / F.lit(6)).alias("households"))


# Queue values of the role visits run 0..490 minutes, so the long-queue probe uses 400.
LONG_QUEUE_MINUTES = 400


@register("k14_long_queue_visits", f"SELECT * FROM visits WHERE time_in_queue > {LONG_QUEUE_MINUTES}")
def k14_long_queue_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir).visits.filter(F.col("time_in_queue") > LONG_QUEUE_MINUTES)


@register("k14_long_queue_sources", f"""
SELECT * FROM water_source
WHERE source_id IN (SELECT source_id FROM visits WHERE time_in_queue > {LONG_QUEUE_MINUTES})""")
def k14_long_queue_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources_by_queue(_t(spark, sf_dir), F.col("time_in_queue") > LONG_QUEUE_MINUTES)


@register("k14_zero_queue_sources", """
SELECT * FROM water_source WHERE source_id IN (SELECT source_id FROM visits WHERE time_in_queue = 0)""")
def k14_zero_queue_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources_by_queue(_t(spark, sf_dir), F.col("time_in_queue") == 0)


@register("k14_listed_sources", "SELECT * FROM water_source WHERE source_id IN (11, 22, 33)")
def k14_listed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir).water_source.filter(F.col("source_id").isin(11, 22, 33))


@register("k15_top_score_second_visit", """
SELECT * FROM water_quality WHERE subjective_quality_score = 10 AND visit_count = 2""")
def k15_top_score_second_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    wq = _t(spark, sf_dir).water_quality
    return wq.filter((F.col("subjective_quality_score") == 10) & (F.col("visit_count") == 2))


@register("k15_top_score_repeat", """
SELECT * FROM water_quality WHERE subjective_quality_score = 10 AND visit_count > 1""")
def k15_top_score_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    wq = _t(spark, sf_dir).water_quality
    return wq.filter((F.col("subjective_quality_score") == 10) & (F.col("visit_count") > 1))


@register("k15_top_score_repeat_sources", """
SELECT wq.source_id, wq.record_id, wq.visit_count, wq.subjective_quality_score, wq.location_id,
       wq.time_of_record, wq.time_in_queue, wq.assigned_employee_id, wq.visit_visit_count,
       ws.type_of_water_source, ws.number_of_people_served
FROM (SELECT q.record_id, q.visit_count, q.subjective_quality_score, v.location_id, v.source_id,
             v.time_of_record, v.time_in_queue, v.assigned_employee_id, v.visit_count AS visit_visit_count
      FROM water_quality q JOIN visits v ON q.record_id = v.record_id
      WHERE q.subjective_quality_score = 10 AND q.visit_count > 1) wq
JOIN water_source ws ON wq.source_id = ws.source_id""")
def k15_top_score_repeat_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_quality_repeats(_t(spark, sf_dir), 10)


@register("k15_top_score_repeat_home", """
SELECT COUNT(*) AS n_rows FROM water_quality q JOIN visits v ON q.record_id = v.record_id
JOIN water_source ws ON v.source_id = ws.source_id
WHERE q.subjective_quality_score = 10 AND q.visit_count > 1 AND ws.type_of_water_source ILIKE '%home%'""")
def k15_top_score_repeat_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = top_quality_repeats(_t(spark, sf_dir), 10).filter(like_ci("type_of_water_source", "%home%"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


@register("s01_scan_location", "SELECT * FROM location")
def s01_scan_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir).location


@register("f15_source_types", "SELECT DISTINCT type_of_water_source FROM water_source")
def f15_source_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(_t(spark, sf_dir).water_source, "type_of_water_source")


@register("f01_auditor_scores", "SELECT location_id, true_water_source_score FROM auditor_report")
def f01_auditor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir).auditor_report.select("location_id", "true_water_source_score")
