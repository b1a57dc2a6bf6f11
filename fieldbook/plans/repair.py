"""Data repair jobs: pollution labels (K-1) and employee contacts (K-2), with their dry runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions.exprs import byte_length, like_ci, not_like_ci
from fieldbook.operators.cleaning import (apply_fixes, bad_phone_numbers, clean_contacts, email_of, fix_report,
                                          mislabelled, pollution_fixes)
from fieldbook.operators.relational import distinct_values
from fieldbook.plans.registry import register
from fieldbook.sources.io import drop_view, read_csv, register_view, shared_path, snapshot, write_csv
from fieldbook.sources.roles import EMAIL_DOMAIN, survey_tables
from fieldbook.sources.tables import load


def _wp(spark, sf_dir) -> DataFrame:
    return survey_tables(spark, sf_dir).well_pollution


def _emp(spark, sf_dir) -> DataFrame:
    return survey_tables(spark, sf_dir).employee


# ---------------------------------------------------------------- K-1 probes


@register("f12_clean_underscore", "SELECT * FROM well_pollution WHERE description ILIKE 'clean_%'")
def f12_clean_underscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wp(spark, sf_dir).filter(like_ci("description", "clean_%"))


@register("f12_clean_descriptions", "SELECT DISTINCT description FROM well_pollution WHERE description ILIKE 'clean_%'")
def f12_clean_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(_wp(spark, sf_dir).filter(like_ci("description", "clean_%")), "description")


@register("f10_clean_results", "SELECT DISTINCT results FROM well_pollution WHERE results ILIKE '%clean%'")
def f10_clean_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(_wp(spark, sf_dir).filter(like_ci("results", "%clean%")), "results")


@register("k01_clean_with_biology", """
SELECT * FROM well_pollution WHERE results = 'Clean' AND biological > 0.01""")
def k01_clean_with_biology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wp(spark, sf_dir).filter((F.col("results") == "Clean") & (F.col("biological") > F.lit(0.01)))


@register("k01_case_1a", "SELECT * FROM well_pollution WHERE description = 'Clean Bacteria: E. coli'")
def k01_case_1a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wp(spark, sf_dir).filter(F.col("description") == "Clean Bacteria: E. coli")


@register("k01_case_1b", "SELECT * FROM well_pollution WHERE description = 'Clean Bacteria: Giardia Lamblia'")
def k01_case_1b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wp(spark, sf_dir).filter(F.col("description") == "Clean Bacteria: Giardia Lamblia")


@register("f13_case_2", """
SELECT * FROM well_pollution
WHERE results = 'Clean' AND biological > 0.01 AND description NOT ILIKE 'Clean%'""")
def f13_case_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    wp = _wp(spark, sf_dir)
    return wp.filter((F.col("results") == "Clean") & (F.col("biological") > F.lit(0.01)) &
                     not_like_ci("description", "Clean%"))


_FIXED = """fixed AS (
    SELECT source_id,
           CASE WHEN description = 'Clean Bacteria: E. coli' THEN 'Bacteria: E. coli'
                WHEN description = 'Clean Bacteria: Giardia Lamblia' THEN 'Bacteria: Giardia Lamblia'
                ELSE description END AS description,
           CASE WHEN biological > 0.01 AND results = 'Clean' THEN 'Contaminated: Biological'
                ELSE results END AS results,
           biological
    FROM well_pollution
)"""


@register("k01_repaired_labels", f"WITH {_FIXED} SELECT * FROM fixed")
def k01_repaired_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_fixes(_wp(spark, sf_dir), pollution_fixes())


@register("s11_apply_fix_on_copy", f"WITH {_FIXED} SELECT * FROM fixed")
def s11_apply_fix_on_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dry run: fix a stored copy (S-6), leaving the original untouched."""
    copy = snapshot(_wp(spark, sf_dir), "well_pollution_copy")
    return apply_fixes(copy, pollution_fixes())


@register("k01_remaining_bad_rows", f"""
WITH {_FIXED}
SELECT * FROM fixed WHERE description ILIKE 'clean_%' OR (results = 'Clean' AND biological > 0.01)""")
def k01_remaining_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mislabelled(apply_fixes(_wp(spark, sf_dir), pollution_fixes()))


@register("s13_fix_report", """
WITH s1 AS (SELECT source_id, results, biological,
                   CASE WHEN description = 'Clean Bacteria: E. coli' THEN 'Bacteria: E. coli'
                        ELSE description END AS description,
                   description = 'Clean Bacteria: E. coli' AS hit
            FROM well_pollution),
     s2 AS (SELECT source_id, results, biological,
                   CASE WHEN description = 'Clean Bacteria: Giardia Lamblia' THEN 'Bacteria: Giardia Lamblia'
                        ELSE description END AS description,
                   description = 'Clean Bacteria: Giardia Lamblia' AS hit
            FROM s1),
     s3 AS (SELECT COALESCE(biological > 0.01 AND results = 'Clean', FALSE) AS hit FROM s2)
SELECT 'case_1a' AS rule, COUNT(*) FILTER (WHERE hit) AS affected_rows FROM s1
UNION ALL SELECT 'case_1b', COUNT(*) FILTER (WHERE hit) FROM s2
UNION ALL SELECT 'case_2', COUNT(*) FILTER (WHERE hit) FROM s3""")
def s13_fix_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fix_report(_wp(spark, sf_dir), pollution_fixes())


@register("s03_csv_round_trip", "SELECT p_partkey, p_type, p_size FROM part")
def s03_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts exported as CSV with a header (S-4) and imported into a declared schema (S-3, S-5)."""
    parts = load(spark, sf_dir, "part", ["p_partkey", "p_type", "p_size"])
    path = shared_path(spark, "part_csv")
    write_csv(parts, path)
    return read_csv(spark, path, parts.schema)


@register("s08_drop_view", """
SELECT r_regionkey, r_name, true AS dropped, false AS still_there FROM region""")
def s08_drop_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a view, and whether the view is gone once dropped."""
    rows = register_view(load(spark, sf_dir, "region", ["r_regionkey", "r_name"]), "region_view")
    dropped = drop_view(spark, "region_view")
    return rows.withColumns({"dropped": F.lit(dropped), "still_there": F.lit(spark.catalog.tableExists("region_view"))})


@register("s06_snapshot_part", "SELECT * FROM part")
def s06_snapshot_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(load(spark, sf_dir, "part"), "part_copy")


# ---------------------------------------------------------------- K-2 contacts

_EMAIL_SQL = f"replace(trim(lower(employee_name)), ' ', '.') || '{EMAIL_DOMAIN}'"


@register("f02_email_preview", f"SELECT {_EMAIL_SQL} AS email FROM employee")
def f02_email_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _emp(spark, sf_dir).select(email_of("employee_name", EMAIL_DOMAIN).alias("email"))


@register("k02_clean_contacts", f"""
SELECT assigned_employee_id, employee_name, trim(phone_number) AS phone_number, town_name,
       {_EMAIL_SQL} AS email
FROM employee""")
def k02_clean_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_contacts(_emp(spark, sf_dir), EMAIL_DOMAIN)


@register("x05_phone_lengths", """
SELECT employee_name, phone_number, CAST(strlen(phone_number) AS INTEGER) AS phone_number_length FROM employee""")
def x05_phone_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _emp(spark, sf_dir)
    return e.select("employee_name", "phone_number", byte_length("phone_number").alias("phone_number_length"))


@register("f19_bad_phone_numbers", """
SELECT trim(phone_number) AS trimmed_phone_number, CAST(strlen(trim(phone_number)) AS INTEGER) AS trimmed_length
FROM employee WHERE strlen(trim(phone_number)) <> 12""")
def f19_bad_phone_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad_phone_numbers(_emp(spark, sf_dir), 12)


@register("f19_raw_phone_not_12", """
SELECT phone_number FROM employee WHERE strlen(phone_number) <> 12""")
def f19_raw_phone_not_12(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _emp(spark, sf_dir)
    return e.filter(byte_length("phone_number") != 12).select("phone_number")


@register("k02_phone_check_after_fix", f"""
SELECT phone_number FROM (SELECT trim(phone_number) AS phone_number FROM employee) e
WHERE strlen(phone_number) <> 12""")
def k02_phone_check_after_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = clean_contacts(_emp(spark, sf_dir), EMAIL_DOMAIN)
    return e.filter(byte_length("phone_number") != 12).select("phone_number")
