"""Key, reference and relationship checks on the driver and survey tables (C-1, C-2, C-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions.exprs import like_ci
from fieldbook.operators.quality import check_domain, check_reference, check_unique, profile_relationship
from fieldbook.operators.relational import count_by
from fieldbook.plans.registry import register
from fieldbook.sources.roles import survey_tables
from fieldbook.sources.tables import load


@register("c01_unique_orders", """
SELECT o_orderkey, COUNT(*) AS n_rows FROM orders GROUP BY 1 HAVING COUNT(*) > 1""")
def c01_unique_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(load(spark, sf_dir, "orders", ["o_orderkey"]), ["o_orderkey"])


@register("c01_unique_lineitem_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def c01_unique_lineitem_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    return check_unique(li, ["l_orderkey", "l_linenumber"])


@register("c01_unique_audit_locations", """
SELECT location_id, COUNT(*) AS n_rows FROM auditor_report GROUP BY 1 HAVING COUNT(*) > 1""")
def c01_unique_audit_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(survey_tables(spark, sf_dir).auditor_report, ["location_id"])


@register("c01_audit_key_counts", """
SELECT COUNT(DISTINCT location_id) AS num_of_audit_locations, COUNT(*) AS num_of_audit_records
FROM auditor_report""")
def c01_audit_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ar = survey_tables(spark, sf_dir).auditor_report
    return ar.agg(F.count_distinct("location_id").alias("num_of_audit_locations"),
                  F.count(F.lit(1)).alias("num_of_audit_records"))


@register("c02_unaudited_visits", """
SELECT v.* FROM visits v
WHERE v.location_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM auditor_report ar WHERE ar.location_id = v.location_id)""")
def c02_unaudited_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = survey_tables(spark, sf_dir)
    return check_reference(t.visits, t.auditor_report, "location_id")


@register("c02_orders_without_customer", """
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""")
def c02_orders_without_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return check_reference(o, load(spark, sf_dir, "customer", ["c_custkey"]), "o_custkey", "c_custkey")


@register("c02_orders_outside_segment", """
SELECT o_orderkey, o_custkey FROM orders
LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') ON c_custkey = o_custkey
WHERE c_custkey IS NULL AND o_custkey IS NOT NULL""")
def c02_orders_outside_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference check against one market segment: orders of all other customers are reported."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"]).filter(F.col("c_mktsegment") == "BUILDING")
    return check_reference(o, c, "o_custkey", "c_custkey")


@register("c04_undeclared_status", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' AND o_orderstatus <> 'O'""")
def c04_undeclared_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose status is outside the allowed list."""
    return check_domain(load(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"]), "o_orderstatus", ("F", "O"))


@register("c01_unique_event_users", """
SELECT user_id, COUNT(*) AS n_rows FROM events GROUP BY 1 HAVING COUNT(*) > 1""")
def c01_unique_event_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(load(spark, sf_dir, "events", ["user_id"]), ["user_id"])


_PROFILE_SQL = """
WITH l AS (SELECT {lk} AS k, COUNT(*) AS ln FROM {left} GROUP BY 1),
     r AS (SELECT {rk} AS k, COUNT(*) AS rn FROM {right} GROUP BY 1),
     b AS (SELECT COALESCE(l.k, r.k) AS k, ln, rn FROM l FULL JOIN r ON l.k = r.k)
SELECT CAST(SUM(ln) AS BIGINT) AS left_rows,
       COUNT(CASE WHEN ln IS NOT NULL AND k IS NOT NULL THEN 1 END) AS left_keys,
       COUNT(CASE WHEN ln > 1 THEN 1 END) AS left_repeated_keys,
       CAST(SUM(rn) AS BIGINT) AS right_rows,
       COUNT(CASE WHEN rn IS NOT NULL AND k IS NOT NULL THEN 1 END) AS right_keys,
       COUNT(CASE WHEN rn > 1 THEN 1 END) AS right_repeated_keys,
       CAST(SUM(CASE WHEN k IS NOT NULL THEN ln * rn END) AS BIGINT) AS joined_rows
FROM b"""


@register("c05_wells_vs_pollution", _PROFILE_SQL.format(
    lk="source_id", rk="source_id", right="well_pollution",
    left="(SELECT * FROM water_source WHERE type_of_water_source ILIKE '%well%')"))
def c05_wells_vs_pollution(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = survey_tables(spark, sf_dir)
    wells = t.water_source.filter(like_ci("type_of_water_source", "%well%"))
    return profile_relationship(wells, t.well_pollution, "source_id")


@register("c05_audit_vs_visits", _PROFILE_SQL.format(
    lk="location_id", rk="location_id", left="auditor_report", right="visits"))
def c05_audit_vs_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = survey_tables(spark, sf_dir)
    return profile_relationship(t.auditor_report, t.visits, "location_id")


@register("c05_audited_multi_visit", """
SELECT ar.location_id AS audited_location, COUNT(v.location_id) AS num_of_pre_audit_visit,
       MAX(ar.type_of_water_source) AS source_type
FROM auditor_report ar JOIN visits v ON ar.location_id = v.location_id
GROUP BY 1 HAVING COUNT(v.location_id) > 1""")
def c05_audited_multi_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = survey_tables(spark, sf_dir)
    # both sides are counted before they meet, so a hot location joins as one row
    visits = count_by(t.visits, ["location_id"], None, "n_visits")
    # type is functionally dependent on the audited location (A-11): any value of the group
    audits = t.auditor_report.groupBy("location_id").agg(
        F.count(F.lit(1)).alias("n_audits"), F.max("type_of_water_source").alias("source_type"))
    return (audits.join(visits, "location_id")
            .select(F.col("location_id").alias("audited_location"),
                    (F.col("n_audits") * F.col("n_visits")).alias("num_of_pre_audit_visit"), "source_type")
            .filter(F.col("num_of_pre_audit_visit") > 1)
            .orderBy(F.desc("num_of_pre_audit_visit")))
