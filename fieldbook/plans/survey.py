"""Survey analyses: who visited, what serves whom, how long the queues are (K-4..K-13, K-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions.exprs import (DIV_DIGITS, avg_nonzero, days_between, exact_avg, exact_div, hour_label,
                                       hour_of_day, like_ci, round_int, weekday_name)
from fieldbook.operators.cleaning import clean_contacts
from fieldbook.operators.ordered import rank_within
from fieldbook.operators.relational import count_by, pivot_avg, semi, share_of_total, top_k
from fieldbook.operators.windows import priority_ranks
from fieldbook.plans.registry import register
from fieldbook.sources.roles import EMAIL_DOMAIN, SOURCE_TYPES, survey_tables
from fieldbook.sources.schemas import QUEUE_PIVOT_COLUMNS
from fieldbook.sources.tables import load

WEEKDAYS = QUEUE_PIVOT_COLUMNS[1:]

# ---------------------------------------------------------------- library functions


def served_by_type(ws: DataFrame) -> DataFrame:
    """K-7: per source type: sources, average and total people served, share and rank."""
    per_type = ws.groupBy("type_of_water_source").agg(
        F.count(F.col("source_id")).alias("num_of_sources"),
        round_int(F.avg("number_of_people_served")).alias("avg_served"),
        F.sum("number_of_people_served").alias("population_served"))
    total = per_type.agg(F.sum("population_served")).scalar()
    share = F.try_divide(F.col("population_served").cast("double"), total.cast("double")) * F.lit(100.0)
    per_type = per_type.withColumn("percentage_people_per_source", round_int(share))
    return rank_within(per_type, [], ["population_served"], descending=True,
                       tiebreak=["type_of_water_source"], rank="rank_by_population")


def normalised_source_counts(ws: DataFrame, household: int = 6) -> DataFrame:
    """K-5: in-home taps count as ``ROUND(count * ROUND(avg) / household)`` sources."""
    agg = ws.groupBy("type_of_water_source").agg(
        F.count(F.col("source_id")).alias("cnt_src"),
        F.round(F.avg("number_of_people_served")).alias("avg_src"))
    home = like_ci("type_of_water_source", "tap_in_home%")
    n = F.when(home, F.round(F.col("cnt_src") * (F.col("avg_src") / F.lit(float(household))))) \
         .otherwise(F.col("cnt_src"))
    return agg.select("type_of_water_source", n.cast("bigint").alias("num_of_source"))


def household_average(ws: DataFrame, household: int = 6) -> DataFrame:
    """K-5: average people per source, fixed to ``household`` for in-home taps."""
    home = like_ci("type_of_water_source", "tap_in_home%")
    avg = F.when(home, F.lit(household)).otherwise(round_int(F.avg("number_of_people_served")))
    return ws.groupBy("type_of_water_source").agg(avg.cast("int").alias("avg_served"))


def population_pct_diff(ws: DataFrame) -> DataFrame:
    """K-6: derived (count x rounded average) against summed population, for in-home taps."""
    agg = (ws.filter(like_ci("type_of_water_source", "tap_in_home%"))
             .groupBy("type_of_water_source").agg(
                 F.count(F.col("source_id")).alias("cnt_src"),
                 F.round(F.avg("number_of_people_served")).alias("avg_src"),
                 F.sum("number_of_people_served").alias("population_served")))
    derived = F.col("cnt_src") * F.col("avg_src")
    err = F.abs(derived - F.col("population_served"))
    avg = (derived + F.col("population_served")) / F.lit(2.0)
    return agg.select(
        "type_of_water_source",
        derived.alias("derived_population_served"),
        "population_served",
        err.alias("abs_error"),
        avg.alias("average"),
        F.round(F.try_divide(err, avg) * F.lit(100.0), 6).alias("pct_diff"))


def population_pct_exact(sources: DataFrame) -> DataFrame:
    """K-6 in exact decimals with MySQL's scales (M-3): nothing is rounded but where the statement does."""
    kind = like_ci("type_of_water_source", "tap_in_home%")
    agg = (sources.filter(kind).groupBy("type_of_water_source")
           .agg(F.count("source_id").alias("cnt_src"),
                F.round(exact_avg("number_of_people_served"), 0).cast("decimal(18,0)").alias("avg_src"),
                F.sum("number_of_people_served").cast("decimal(18,0)").alias("population_served")))
    derived = (F.col("cnt_src").cast("decimal(18,0)") * F.col("avg_src")).cast("decimal(18,0)")
    both = agg.withColumn("derived", derived)
    average = exact_div(F.col("derived") + F.col("population_served"), F.lit(2))
    err = F.abs(F.col("derived") - F.col("population_served"))
    pct = exact_div(err, average, den_scale=DIV_DIGITS) * F.lit(100).cast("decimal(3,0)")
    return both.select("type_of_water_source", F.col("derived").cast("string").alias("derived_population_served"),
                       average.cast("string").alias("average"), pct.cast("decimal(30,4)").cast("string").alias("pct_diff"))


def queue_pivot(visits: DataFrame) -> DataFrame:
    """K-12: average non-zero queue by hour label (rows) and weekday (columns)."""
    # weekday and hour are formatted once per row, below the aggregate
    v = (visits.filter(F.col("time_in_queue") != 0)
               .select(hour_label("time_of_record").alias("hour_of_day"),
                       weekday_name("time_of_record").alias("_day"), "time_in_queue"))
    day = F.col("_day")
    values = [(d, like_ci(day, f"%{d}%")) for d in WEEKDAYS]
    return pivot_avg(v, "hour_of_day", day, values, "time_in_queue", "hour_of_day")


def queue_by(visits: DataFrame, grain) -> DataFrame:
    """K-11: ``ROUND(AVG(NULLIF(time_in_queue, 0)))``, globally or per time grain."""
    avg = round_int(avg_nonzero("time_in_queue")).alias("avg_queue_time")
    if grain is None:
        return visits.agg(avg)
    return visits.groupBy(grain).agg(avg)


def pollution_share(wp: DataFrame) -> DataFrame:
    """K-8: well pollution results in percent of all wells."""
    return share_of_total(wp, ["results"], "source_id", "count", "pollution_dist", "pct_pollution_dist")


def survey_duration(visits: DataFrame) -> DataFrame:
    """K-10: days between the first and the last visit."""
    return visits.agg(days_between(F.max("time_of_record"), F.min("time_of_record")).alias("total_visits_duration"))


def queue_presence_by_type(visits: DataFrame, sources: DataFrame, zero_queue: bool) -> DataFrame:
    """K-13: visits with (or without) a queue, per source type (visits LEFT JOIN sources)."""
    q = F.col("time_in_queue")
    v = visits.filter((q == 0) if zero_queue else (q != 0))
    joined = v.join(sources.select("source_id", "type_of_water_source"), "source_id", "left")
    return count_by(joined, ["type_of_water_source"], "source_id", "num_of_sources")


def location_counts(locations: DataFrame, keys, out: str) -> DataFrame:
    """K-16: locations per town, province, (province, town) or type."""
    return count_by(locations, keys, "location_id", out)


def top_k_profile(visit_keys: DataFrame, employees: DataFrame, k: int = 3) -> DataFrame:
    """K-4: the ``k`` employees with the most visits, with their contact profile.

    The top-k table has at most ``k`` rows: broadcasting it is bounded.
    """
    top = top_k(visit_keys, "assigned_employee_id", k, "num_of_visits")
    return (employees.join(F.broadcast(top), "assigned_employee_id")
                     .select("employee_name", "email", "phone_number", "assigned_employee_id", "num_of_visits"))


# ---------------------------------------------------------------- bindings


def _employees(spark, sf_dir):
    return clean_contacts(survey_tables(spark, sf_dir).employee, EMAIL_DOMAIN)


def _visit_keys(spark, sf_dir):
    # Role visits split employees evenly (exact ties), so the top-k binding
    # counts supplier keys of lineitem.
    return load(spark, sf_dir, "lineitem", ["l_suppkey"]).select(F.col("l_suppkey").alias("assigned_employee_id"))


_EMP_CLEAN = f"""
    SELECT employee_name, replace(trim(lower(employee_name)), ' ', '.') || '{EMAIL_DOMAIN}' AS email,
           trim(phone_number) AS phone_number, assigned_employee_id, town_name
    FROM employee"""

_TOP3 = """SELECT l_suppkey AS assigned_employee_id, COUNT(l_suppkey) AS num_of_visits
           FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3"""


@register("k04_top_k_profile", f"""
WITH emp AS ({_EMP_CLEAN}), evc AS ({_TOP3})
SELECT employee_name, email, phone_number, evc.assigned_employee_id, num_of_visits
FROM emp JOIN evc ON emp.assigned_employee_id = evc.assigned_employee_id""")
def k04_top_k_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_profile(_visit_keys(spark, sf_dir), _employees(spark, sf_dir), 3)


@register("k04_top_k_in", f"""
WITH emp AS ({_EMP_CLEAN}), evc AS ({_TOP3})
SELECT employee_name, email, phone_number FROM emp
WHERE assigned_employee_id IN (SELECT assigned_employee_id FROM evc)""")
def k04_top_k_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_k(_visit_keys(spark, sf_dir), "assigned_employee_id", 3, "num_of_visits")
    return semi(_employees(spark, sf_dir), top, "assigned_employee_id").select(
        "employee_name", "email", "phone_number")


@register("k05_normalised_source_counts", """
WITH a AS (SELECT type_of_water_source, COUNT(source_id) AS cnt_src,
                  ROUND(AVG(number_of_people_served)) AS avg_src
           FROM water_source GROUP BY 1)
SELECT type_of_water_source,
       CAST(CASE WHEN type_of_water_source ILIKE 'tap_in_home%' THEN ROUND(cnt_src * (avg_src / 6.0))
                 ELSE cnt_src END AS BIGINT) AS num_of_source
FROM a""")
def k05_normalised_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalised_source_counts(survey_tables(spark, sf_dir).water_source)


@register("k05_household_average", """
SELECT type_of_water_source,
       CAST(CASE WHEN type_of_water_source ILIKE 'tap_in_home%' THEN 6
                 ELSE ROUND(AVG(number_of_people_served)) END AS INTEGER) AS avg_served
FROM water_source GROUP BY 1""")
def k05_household_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return household_average(survey_tables(spark, sf_dir).water_source)


@register("k06_population_pct_diff", """
WITH a AS (SELECT type_of_water_source, COUNT(source_id) AS cnt_src,
                  ROUND(AVG(number_of_people_served)) AS avg_src,
                  CAST(SUM(number_of_people_served) AS BIGINT) AS population_served
           FROM water_source WHERE type_of_water_source ILIKE 'tap_in_home%' GROUP BY 1)
SELECT type_of_water_source, cnt_src * avg_src AS derived_population_served, population_served,
       abs(cnt_src * avg_src - population_served) AS abs_error,
       (cnt_src * avg_src + population_served) / 2.0 AS average,
       ROUND(abs(cnt_src * avg_src - population_served) / ((cnt_src * avg_src + population_served) / 2.0) * 100.0, 6)
           AS pct_diff
FROM a""")
def k06_population_pct_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population_pct_diff(survey_tables(spark, sf_dir).water_source)


@register("k06_population_pct_exact", """
WITH a AS (SELECT type_of_water_source AS kind, COUNT(source_id) * ((2 * SUM(number_of_people_served) + COUNT(number_of_people_served))
                  // (2 * COUNT(number_of_people_served))) AS d, SUM(number_of_people_served) AS p
           FROM water_source WHERE type_of_water_source ILIKE 'tap_in_home%' GROUP BY 1),
b AS (SELECT kind, d, d + p AS twice, (2 * abs(d - p) * 20000 + d + p) // (2 * (d + p)) AS k FROM a)
SELECT kind AS type_of_water_source, CAST(d AS VARCHAR) AS derived_population_served,
       CAST(twice // 2 AS VARCHAR) || CASE WHEN twice % 2 = 0 THEN '.0000' ELSE '.5000' END AS average,
       CAST(k // 100 AS VARCHAR) || '.' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') || '00' AS pct_diff
FROM b""")
def k06_population_pct_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return population_pct_exact(survey_tables(spark, sf_dir).water_source)


@register("k07_served_by_type", """
WITH a AS (SELECT type_of_water_source, COUNT(source_id) AS num_of_sources,
                  CAST(ROUND(AVG(number_of_people_served)) AS INTEGER) AS avg_served,
                  CAST(SUM(number_of_people_served) AS BIGINT) AS population_served
           FROM water_source GROUP BY 1)
SELECT type_of_water_source, num_of_sources, avg_served, population_served,
       CAST(ROUND(population_served / (SELECT SUM(number_of_people_served) FROM water_source) * 100) AS INTEGER)
           AS percentage_people_per_source,
       CAST(RANK() OVER (ORDER BY population_served DESC) AS INTEGER) AS rank_by_population
FROM a""")
def k07_served_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return served_by_type(survey_tables(spark, sf_dir).water_source)


@register("k07_total_surveyed", """
SELECT CAST(SUM(number_of_people_served) AS BIGINT) AS total_num_of_people_surveyed FROM water_source""")
def k07_total_surveyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = survey_tables(spark, sf_dir).water_source
    return ws.agg(F.sum("number_of_people_served").alias("total_num_of_people_surveyed"))


@register("k08_pollution_share", """
SELECT results, COUNT(source_id) AS pollution_dist,
       CAST(ROUND(COUNT(source_id) / (SELECT COUNT(source_id) FROM well_pollution) * 100) AS INTEGER)
           AS pct_pollution_dist
FROM well_pollution GROUP BY 1""")
def k08_pollution_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pollution_share(survey_tables(spark, sf_dir).well_pollution)


@register("k09_priority_ranks", """
SELECT source_id, type_of_water_source, number_of_people_served,
       CAST(RANK() OVER (PARTITION BY type_of_water_source ORDER BY number_of_people_served DESC) AS INTEGER)
           AS priority_rank,
       CAST(DENSE_RANK() OVER (PARTITION BY type_of_water_source ORDER BY number_of_people_served DESC) AS INTEGER)
           AS priority_dense_rank,
       CAST(ROW_NUMBER() OVER (PARTITION BY type_of_water_source
                               ORDER BY number_of_people_served DESC, source_id) AS INTEGER) AS priority_row_number
FROM water_source WHERE type_of_water_source <> 'tap_in_home'""")
def k09_priority_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = survey_tables(spark, sf_dir).water_source.filter(F.col("type_of_water_source") != "tap_in_home")
    return priority_ranks(ws, "type_of_water_source", "number_of_people_served", "source_id",
                          "priority_rank", "priority_dense_rank", "priority_row_number")


@register("k10_survey_duration", """
SELECT CAST(date_diff('day', CAST(MIN(time_of_record) AS DATE), CAST(MAX(time_of_record) AS DATE)) AS INTEGER)
           AS total_visits_duration
FROM visits""")
def k10_survey_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_duration(survey_tables(spark, sf_dir).visits)


@register("k11_queue_avg", """
SELECT CAST(ROUND(AVG(NULLIF(time_in_queue, 0))) AS INTEGER) AS avg_queue_time FROM visits""")
def k11_queue_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue_by(survey_tables(spark, sf_dir).visits, None)


@register("k11_queue_by_weekday", """
SELECT dayname(time_of_record) AS day_of_week,
       CAST(ROUND(AVG(NULLIF(time_in_queue, 0))) AS INTEGER) AS avg_queue_time
FROM visits GROUP BY 1""")
def k11_queue_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = survey_tables(spark, sf_dir).visits
    return queue_by(v, weekday_name("time_of_record").alias("day_of_week")).orderBy(F.desc("avg_queue_time"))


@register("k11_queue_by_hour", """
SELECT CAST(hour(time_of_record) AS INTEGER) AS hour_of_day,
       CAST(ROUND(AVG(NULLIF(time_in_queue, 0))) AS INTEGER) AS avg_queue_time
FROM visits GROUP BY 1""")
def k11_queue_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = survey_tables(spark, sf_dir).visits
    return queue_by(v, hour_of_day("time_of_record").alias("hour_of_day")).orderBy(F.desc("avg_queue_time"))


@register("k11_queue_by_hour_label", """
SELECT strftime(time_of_record, '%H:00') AS hour_of_day,
       CAST(ROUND(AVG(NULLIF(time_in_queue, 0))) AS INTEGER) AS avg_queue_time
FROM visits GROUP BY 1""")
def k11_queue_by_hour_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = survey_tables(spark, sf_dir).visits
    return queue_by(v, hour_label("time_of_record").alias("hour_of_day")).orderBy(F.desc("avg_queue_time"))


_PIVOT_COLS = ",\n".join(
    f"CAST(ROUND(AVG(CASE WHEN dayname(time_of_record) ILIKE '%{d}%' THEN time_in_queue END)) AS INTEGER) AS {d}"
    for d in WEEKDAYS)


@register("k12_queue_pivot", f"""
SELECT strftime(time_of_record, '%H:00') AS hour_of_day,
{_PIVOT_COLS}
FROM visits WHERE time_in_queue <> 0 GROUP BY 1 ORDER BY 1""")
def k12_queue_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue_pivot(survey_tables(spark, sf_dir).visits).orderBy("hour_of_day")


@register("k12_queue_long", """
SELECT record_id, strftime(time_of_record, '%H:00') AS hour_of_day, dayname(time_of_record) AS day_of_week,
       CASE WHEN dayname(time_of_record) ILIKE '%sunday%' THEN time_in_queue END AS sunday
FROM visits WHERE time_in_queue <> 0""")
def k12_queue_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = survey_tables(spark, sf_dir).visits.filter(F.col("time_in_queue") != 0)
    day = weekday_name("time_of_record")
    return v.select("record_id", hour_label("time_of_record").alias("hour_of_day"), day.alias("day_of_week"),
                    F.when(like_ci(day, "%sunday%"), F.col("time_in_queue")).alias("sunday"))


def _queue_presence(spark, sf_dir, zero: bool) -> DataFrame:
    t = survey_tables(spark, sf_dir)
    return queue_presence_by_type(t.visits, t.water_source, zero)


@register("k13_zero_queue_by_type", """
SELECT ws.type_of_water_source, COUNT(v.source_id) AS num_of_sources
FROM visits v LEFT JOIN water_source ws ON v.source_id = ws.source_id
WHERE v.time_in_queue = 0 GROUP BY 1""")
def k13_zero_queue_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue_presence(spark, sf_dir, True)


@register("k13_queue_by_type", """
SELECT ws.type_of_water_source, COUNT(v.source_id) AS num_of_sources
FROM visits v LEFT JOIN water_source ws ON v.source_id = ws.source_id
WHERE v.time_in_queue <> 0 GROUP BY 1""")
def k13_queue_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue_presence(spark, sf_dir, False)


@register("k13_well_count", """
SELECT COUNT(source_id) AS num_of_wells FROM water_source WHERE type_of_water_source ILIKE '%well%'""")
def k13_well_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = survey_tables(spark, sf_dir).water_source
    return ws.filter(like_ci("type_of_water_source", "%well%")).agg(F.count("source_id").alias("num_of_wells"))


@register("k16_records_per_town", """
SELECT COUNT(location_id) AS records_per_town, town_name FROM location GROUP BY 2""")
def k16_records_per_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = survey_tables(spark, sf_dir).location
    return location_counts(loc, ["town_name"], "records_per_town").orderBy(F.desc("records_per_town"))


@register("k16_records_per_province", """
SELECT COUNT(location_id) AS records_per_province, province_name FROM location GROUP BY 2""")
def k16_records_per_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = survey_tables(spark, sf_dir).location
    return location_counts(loc, ["province_name"], "records_per_province") \
        .orderBy(F.desc("records_per_province"))


@register("k16_records_per_province_town", """
SELECT province_name, town_name, COUNT(location_id) AS records_per_town FROM location GROUP BY 1, 2""")
def k16_records_per_province_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = survey_tables(spark, sf_dir).location
    return location_counts(loc, ["province_name", "town_name"], "records_per_town") \
        .orderBy("province_name", F.desc("records_per_town"))


@register("k16_location_type_share", """
SELECT COUNT(location_id) AS num_of_sources,
       CAST(ROUND(COUNT(location_id) / (SELECT COUNT(location_id) FROM location) * 100) AS INTEGER)
           AS percentage_share,
       location_type
FROM location GROUP BY 3""")
def k16_location_type_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    loc = survey_tables(spark, sf_dir).location
    return share_of_total(loc, ["location_type"], "location_id", "count", "num_of_sources", "percentage_share") \
        .orderBy("num_of_sources")


@register("k16_employees_per_town", """
SELECT town_name AS town, COUNT(assigned_employee_id) AS num_of_employees FROM employee GROUP BY 1""")
def k16_employees_per_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    emp = survey_tables(spark, sf_dir).employee
    return count_by(emp, [F.col("town_name").alias("town")], "assigned_employee_id", "num_of_employees")


@register("k16_visits_per_employee", """
SELECT assigned_employee_id, COUNT(assigned_employee_id) AS number_of_visits FROM visits GROUP BY 1""")
def k16_visits_per_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = survey_tables(spark, sf_dir).visits
    return count_by(v, ["assigned_employee_id"], "assigned_employee_id", "number_of_visits")
