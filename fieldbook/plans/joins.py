"""Join operators bound to driver and survey tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.operators.relational import not_in, semi, top_k, with_group_total
from fieldbook.plans.registry import register
from fieldbook.sources.io import snapshot
from fieldbook.sources.roles import survey_tables
from fieldbook.sources.tables import load


@register("j01_join_using", """
SELECT orderkey, o_orderstatus, l_linenumber, l_quantity
FROM (SELECT o_orderkey AS orderkey, o_orderstatus FROM orders) o
JOIN (SELECT l_orderkey AS orderkey, l_linenumber, l_quantity FROM lineitem) l USING (orderkey)""")
def j01_join_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderstatus")
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    return o.join(li, "orderkey")


@register("j02_join_on", """
SELECT c.c_custkey, c.c_name, c.c_nationkey, n.n_nationkey, n.n_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def j02_join_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", "c_name", "c_nationkey", "n_nationkey", "n_name")


@register("j03_multiway_chain", """
SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")
def j03_multiway_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey) \
         .join(r, n.n_regionkey == r.r_regionkey)
    return j.select("o_orderkey", "c_name", "n_name", "r_name")


@register("j04_left_join", """
SELECT v.record_id, v.source_id, p.results
FROM visits v LEFT JOIN well_pollution p ON v.source_id = p.source_id""")
def j04_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = survey_tables(spark, sf_dir)
    v = t.visits.select("record_id", "source_id")
    return v.join(t.well_pollution.select("source_id", "results"), "source_id", "left") \
            .select("record_id", "source_id", "results")


@register("j04_customers_left_orders", """
SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey""")
def j04_customers_left_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer", ["c_custkey"])
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "o_orderkey")


@register("j06_comma_join", """
SELECT s_suppkey, s_name, num_of_visits
FROM (SELECT l_suppkey AS s_suppkey, COUNT(*) AS num_of_visits,
             ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, l_suppkey) AS place
      FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY 1)
JOIN supplier USING (s_suppkey) WHERE place <= 3""")
def j06_comma_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    top = top_k(load(spark, sf_dir, "lineitem", ["l_suppkey"]), "l_suppkey", 3, "num_of_visits")
    # the top-k side has at most 3 rows, so the broadcast is bounded
    return s.join(F.broadcast(top), s.s_suppkey == top.l_suppkey).select("s_suppkey", "s_name", "num_of_visits")


@register("j08_group_total", """
SELECT province_name, type_of_water_source AS source_type, number_of_people_served AS people_served,
       CAST(SUM(number_of_people_served) OVER (PARTITION BY province_name) AS BIGINT) AS total_ppl_serv
FROM (SELECT location_id, source_id FROM visits WHERE visit_count = 1)
JOIN water_source USING (source_id) JOIN location USING (location_id)""")
def j08_group_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = survey_tables(spark, sf_dir)
    v = t.visits.filter(F.col("visit_count") == 1).select("location_id", "source_id")
    c = v.join(t.location, "location_id").join(t.water_source, "source_id").select(
        "province_name", F.col("type_of_water_source").alias("source_type"),
        F.col("number_of_people_served").alias("people_served"))
    # stored, so that the joins run once for the rows and their totals
    return with_group_total(snapshot(c, "served"), ["province_name"], "people_served", "total_ppl_serv") \
        .select("province_name", "source_type", "people_served", "total_ppl_serv")


@register("j09_semi_join", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)""")
def j09_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    big = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_quantity"]).filter(F.col("l_quantity") >= 49)
    return semi(o, big, "o_orderkey", "l_orderkey")


@register("j10_not_in", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def j10_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    return not_in(c, load(spark, sf_dir, "orders", ["o_custkey"]), "c_custkey", "o_custkey")


@register("j10_not_in_large_orders", """
SELECT c_custkey, c_name FROM customer
EXCEPT ALL
SELECT c_custkey, c_name FROM customer
WHERE (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000) > 0""")
def j10_not_in_large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order above 200,000."""
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    large = load(spark, sf_dir, "orders", ["o_custkey", "o_totalprice"]).filter(F.col("o_totalprice") > 200000)
    return not_in(c, large, "c_custkey", "o_custkey")


@register("j07_composite_key_join", """
SELECT record_id, province_name, town_name, number_of_people_served AS people_served,
       CAST(SUM(number_of_people_served) OVER (PARTITION BY province_name, town_name) AS BIGINT) AS total_ppl_serv
FROM (SELECT record_id, location_id, source_id FROM visits WHERE visit_count = 1)
JOIN water_source USING (source_id) JOIN location USING (location_id)""")
def j07_composite_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = survey_tables(spark, sf_dir)
    v = t.visits.filter(F.col("visit_count") == 1).select("record_id", "location_id", "source_id")
    c = v.join(t.location, "location_id").join(t.water_source, "source_id").select(
        "record_id", "province_name", "town_name", F.col("number_of_people_served").alias("people_served"))
    # town names repeat across provinces, so the totals join on (province, town)
    return with_group_total(snapshot(c, "served"), ["province_name", "town_name"], "people_served", "total_ppl_serv") \
        .select("record_id", "province_name", "town_name", "people_served", "total_ppl_serv")
