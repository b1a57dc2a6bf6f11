"""Single-operator queries on the driver tables: scans, projections, filters, scalar functions
(SURVEY 2.1, 2.2, 2.8).  Each one is a thin binding of a library operator to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions.exprs import (byte_length, concat_str, days_between, hour_label, hour_of_day, if_,
                                       like_ci, weekday_name)
from fieldbook.operators.relational import distinct_values
from fieldbook.plans.registry import register
from fieldbook.sources.tables import load, preview_size


@register("s01_scan_customer", "SELECT * FROM customer")
def s01_scan_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer")


@register("s02_preview_nation", "SELECT COUNT(*) AS preview_rows FROM (SELECT * FROM nation LIMIT 10) p")
def s02_preview_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_size(load(spark, sf_dir, "nation"), 10)


@register("f01_projection_aliases", """
SELECT c_custkey AS id, c_name AS "name", c_acctbal AS balance FROM customer""")
def f01_projection_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))


@register("f02_computed_projection", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net_price,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge
FROM lineitem""")
def f02_computed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", net.alias("net_price"),
                     (net * (F.lit(1) + F.col("l_tax"))).alias("charge"))


@register("f04_string_equality", "SELECT p_partkey, p_name, p_type FROM part WHERE p_type = 'PROMO'")
def f04_string_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").filter(F.col("p_type") == "PROMO").select("p_partkey", "p_name", "p_type")


@register("f05_numeric_comparison", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 49""")
def f05_numeric_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.filter(F.col("l_quantity") >= 49).select("l_orderkey", "l_linenumber", "l_quantity")


@register("f06_not_equal", "SELECT p_partkey, p_type FROM part WHERE p_type <> 'MEDIUM'")
def f06_not_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").filter(F.col("p_type") != "MEDIUM").select("p_partkey", "p_type")


@register("f07_conjunction", """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_quantity > 45 AND l_discount >= 0.05 AND l_returnflag = 'R'""")
def f07_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    cond = (F.col("l_quantity") > 45) & (F.col("l_discount") >= F.lit(0.05)) & (F.col("l_returnflag") == "R")
    return li.filter(cond).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@register("f08_disjunction", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
WHERE l_returnflag = 'R' OR (l_quantity < 2 AND l_linestatus = 'O')""")
def f08_disjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    cond = (F.col("l_returnflag") == "R") | ((F.col("l_quantity") < 2) & (F.col("l_linestatus") == "O"))
    return li.filter(cond).select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@register("f09_in_list", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def f09_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey", "o_orderstatus")


@register("f10_like_contains", "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%customer#0000001%'")
def f10_like_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return c.filter(like_ci("c_name", "%customer#0000001%")).select("c_custkey", "c_name")


@register("f11_like_prefix", "SELECT p_partkey, p_type FROM part WHERE p_type ILIKE 'pro%'")
def f11_like_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").filter(like_ci("p_type", "pro%")).select("p_partkey", "p_type")


@register("f15_distinct", "SELECT DISTINCT p_type FROM part")
def f15_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(load(spark, sf_dir, "part"), "p_type")


@register("f16_distinct_expression", "SELECT DISTINCT CAST(ROUND(p_size * 100, -2) AS INTEGER) AS size_bucket FROM part")
def f16_distinct_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return distinct_values(p, F.round(F.col("p_size") * 100, -2).cast("int").alias("size_bucket"))


@register("f17_searched_case", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity >= 40 THEN 'bulk' WHEN l_quantity >= 20 THEN 'medium'
            WHEN l_quantity >= 5 THEN 'small' END AS size_class
FROM lineitem""")
def f17_searched_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    cls = F.when(q >= 40, "bulk").when(q >= 20, "medium").when(q >= 5, "small")
    return li.select("l_orderkey", "l_linenumber", cls.alias("size_class"))


@register("x01_string_functions", """
SELECT c_custkey, lower(c_name) AS lower_name, trim('  ' || c_name || ' ') AS trimmed,
       replace(c_name, '#', ' ') AS replaced, c_name || '-' || CAST(c_custkey AS VARCHAR) AS tagged,
       CAST(strlen(c_name) AS INTEGER) AS name_bytes
FROM customer""")
def x01_string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    name = F.col("c_name")
    return c.select("c_custkey", F.lower(name).alias("lower_name"),
                    F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
                    F.replace(name, F.lit("#"), F.lit(" ")).alias("replaced"),
                    concat_str(name, "-", F.col("c_custkey")).alias("tagged"),
                    byte_length(name).alias("name_bytes"))


@register("x06_rounding", """
SELECT p_partkey, ROUND(p_retailprice) AS rounded, CAST(ROUND(p_size * 55, -2) AS INTEGER) AS hundreds,
       ROUND(p_retailprice / 7, 0) AS rounded0
FROM part""")
def x06_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", F.round("p_retailprice").alias("rounded"),
                    F.round(F.col("p_size") * 55, -2).cast("int").alias("hundreds"),
                    F.round(F.col("p_retailprice") / F.lit(7), 0).alias("rounded0"))


@register("x09_abs_floor_if", """
SELECT l_orderkey, l_linenumber, abs(l_discount - 0.05) AS discount_gap,
       CAST(floor(l_extendedprice / 1000) AS BIGINT) AS thousands,
       CASE WHEN l_quantity > 25 THEN 'large' ELSE 'small' END AS half
FROM lineitem""")
def x09_abs_floor_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.abs(F.col("l_discount") - F.lit(0.05)).alias("discount_gap"),
                     F.floor(F.col("l_extendedprice") / F.lit(1000)).cast("bigint").alias("thousands"),
                     if_(F.col("l_quantity") > 25, F.lit("large"), F.lit("small")).alias("half"))


@register("x12_nullif", "SELECT l_orderkey, l_linenumber, NULLIF(l_discount, 0) AS discount FROM lineitem")
def x12_nullif(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"))


@register("x14_datediff", """
SELECT o_orderkey, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS age_days
FROM orders""")
def x14_datediff(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", days_between(F.col("o_orderdate"), F.lit("1995-01-01")).alias("age_days"))


@register("x15_time_parts", """
SELECT event_id, dayname(ts) AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour_of_day,
       strftime(ts, '%H:00') AS hour_label
FROM events""")
def x15_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select("event_id", weekday_name("ts").alias("day_of_week"), hour_of_day("ts").alias("hour_of_day"),
                    hour_label("ts").alias("hour_label"))
