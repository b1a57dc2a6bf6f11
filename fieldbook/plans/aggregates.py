"""Aggregates, windows and sorts bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.functions.exprs import exact_avg, hour_label, like_ci, round_int
from fieldbook.operators.relational import count_by, distinct_values, pivot_share, share_of_total, top_k, with_group_max
from fieldbook.operators.ordered import rank_within
from fieldbook.operators.windows import latest_per_key, lead_gap, priority_ranks, rank_groups
from fieldbook.plans.registry import register
from fieldbook.sources.roles import survey_tables
from fieldbook.sources.schemas import collated
from fieldbook.sources.tables import load

_NATIVE_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                   "embeddings", "pages", "benchmark", "labels", "conversations")


@register("a01_count_all", "SELECT " + ", ".join(f"(SELECT COUNT(*) FROM {t}) AS n_{t}" for t in _NATIVE_COUNTED))
def a01_count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = [load(spark, sf_dir, t).agg(F.count(F.lit(1))).scalar().alias(f"n_{t}") for t in _NATIVE_COUNTED]
    return spark.range(1).select(*cols)


@register("a02_count_per_key", "SELECT o_custkey, COUNT(o_orderkey) AS num_orders FROM orders GROUP BY 1")
def a02_count_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(load(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "num_orders")


@register("a03_count_distinct", """
SELECT COUNT(DISTINCT l_suppkey) AS num_suppliers,
       COUNT(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_suppkey END) AS num_suppliers_returned
FROM lineitem""")
def a03_count_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    return li.agg(F.count_distinct("l_suppkey").alias("num_suppliers"),
                  F.count_distinct(F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")))
                   .alias("num_suppliers_returned"))


@register("a04_sum_avg_min_max", """
SELECT CAST(SUM(p_size) AS BIGINT) AS total_size, AVG(p_size) AS avg_size, MIN(p_size) AS min_size,
       MAX(p_size) AS max_size FROM part""")
def a04_sum_avg_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.agg(F.sum("p_size").alias("total_size"), F.avg("p_size").alias("avg_size"),
                 F.min("p_size").alias("min_size"), F.max("p_size").alias("max_size"))


@register("a06_date_range", """
SELECT MIN(o_orderdate) AS first_order, MAX(o_orderdate) AS last_order FROM orders""")
def a06_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))


@register("a08_group_several_keys", """
SELECT r.r_name, n.n_name, COUNT(c.c_custkey) AS num_customers
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2 ORDER BY 1, 3 DESC""")
def a08_group_several_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return count_by(j, ["r_name", "n_name"], "c_custkey", "num_customers").orderBy("r_name", F.desc("num_customers"))


@register("a09_group_by_expression", """
SELECT strftime(ts, '%H:00') AS hour_of_day, COUNT(*) AS num_events,
       CAST(ROUND(AVG(value)) AS INTEGER) AS avg_value
FROM events GROUP BY 1""")
def a09_group_by_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.groupBy(hour_label("ts").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("num_events"), round_int(F.avg("value")).alias("avg_value"))


@register("a10_having", """
SELECT o_custkey, COUNT(*) AS num_orders FROM orders GROUP BY 1 HAVING COUNT(*) > 15""")
def a10_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return count_by(o, ["o_custkey"], None, "num_orders").filter(F.col("num_orders") > 15)


@register("a12_share_of_total", """
SELECT c_mktsegment, COUNT(c_custkey) AS num_customers,
       CAST(ROUND(COUNT(c_custkey) / (SELECT COUNT(c_custkey) FROM customer) * 100) AS INTEGER) AS pct_customers
FROM customer GROUP BY 1""")
def a12_share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    return share_of_total(c, ["c_mktsegment"], "c_custkey", "count", "num_customers", "pct_customers")


@register("a12_sum_share", """
SELECT c_mktsegment, ROUND(SUM(c_acctbal), 2) AS balance,
       CAST(ROUND(SUM(c_acctbal) / (SELECT SUM(c_acctbal) FROM customer) * 100) AS INTEGER) AS pct_balance
FROM customer GROUP BY 1""")
def a12_sum_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    out = share_of_total(c, ["c_mktsegment"], "c_acctbal", "sum", "balance", "pct_balance")
    return out.withColumn("balance", F.round("balance", 2))


@register("a18_expressions_over_aggregates", """
SELECT p_type, CAST(ROUND(COUNT(*) / 2) AS BIGINT) AS half_count, MAX(p_size) - MIN(p_size) AS size_span,
       CAST(CASE WHEN p_type ILIKE 'pro%' THEN 0 ELSE ROUND(AVG(p_size)) END AS INTEGER) AS avg_size
FROM part GROUP BY 1""")
def a18_expressions_over_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    avg = F.when(like_ci("p_type", "pro%"), F.lit(0)).otherwise(round_int(F.avg("p_size")))
    return p.groupBy("p_type").agg(
        F.round(F.count(F.lit(1)) / F.lit(2)).cast("bigint").alias("half_count"),
        (F.max("p_size") - F.min("p_size")).alias("size_span"),
        avg.cast("int").alias("avg_size"))


@register("a20_aggregate_of_aggregate", """
SELECT AVG(num_orders) AS avg_orders_per_customer
FROM (SELECT o_custkey, COUNT(o_orderkey) AS num_orders FROM orders GROUP BY 1) c""")
def a20_aggregate_of_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = count_by(load(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "num_orders")
    return per.agg(F.avg("num_orders").alias("avg_orders_per_customer"))


@register("w01_rank_over_aggregate", """
SELECT p_type, CAST(SUM(p_size) AS BIGINT) AS total_size,
       CAST(RANK() OVER (ORDER BY SUM(p_size) DESC) AS INTEGER) AS size_rank
FROM part GROUP BY 1""")
def w01_rank_over_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_groups(load(spark, sf_dir, "part"), "p_type", "p_size", "total_size", "size_rank")


@register("w02_rank_within_partition", """
SELECT p_partkey, p_type, p_size,
       CAST(RANK() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS INTEGER) AS size_rank,
       CAST(DENSE_RANK() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS INTEGER) AS size_dense_rank,
       CAST(ROW_NUMBER() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey) AS INTEGER) AS size_row_number
FROM part""")
def w02_rank_within_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part", ["p_partkey", "p_type", "p_size"])
    return priority_ranks(p, "p_type", "p_size", "p_partkey", "size_rank", "size_dense_rank", "size_row_number")


@register("w03_rank_hot_groups", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
       CAST(RANK() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS INTEGER) AS qty_rank,
       CAST(DENSE_RANK() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS INTEGER) AS qty_dense_rank
FROM lineitem""")
def w03_rank_hot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks inside three groups that each hold about a third of lineitem, with heavy ties.

    The range-partitioned pass spreads every return flag over many tasks,
    where a window would run three tasks of a third of the table each.
    """
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"])
    return rank_within(li, ["l_returnflag"], ["l_quantity"], descending=True,
                       tiebreak=["l_orderkey", "l_linenumber"], rank="qty_rank", dense_rank="qty_dense_rank")


@register("w05_lead_gap", """
SELECT o_custkey, COUNT(o_orderkey) AS num_orders,
       COUNT(o_orderkey) - LEAD(COUNT(o_orderkey)) OVER (ORDER BY COUNT(o_orderkey) DESC, o_custkey) AS lead_diff
FROM orders GROUP BY 1""")
def w05_lead_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = count_by(load(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "num_orders")
    return lead_gap(per, "o_custkey", "num_orders", "next_orders", "lead_diff").select(
        "o_custkey", "num_orders", "lead_diff")


@register("w06_max_over_partition", """
SELECT o_orderkey, o_custkey, o_totalprice, MAX(o_totalprice) OVER (PARTITION BY o_custkey) AS max_price
FROM orders""")
def w06_max_over_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    return with_group_max(o, ["o_custkey"], "o_totalprice", "max_price") \
        .select("o_orderkey", "o_custkey", "o_totalprice", "max_price")


@register("w07_latest_visit", """
SELECT location_id, record_id, visit_count FROM visits v
WHERE visit_count = (SELECT MAX(visit_count) FROM visits v2 WHERE v2.location_id = v.location_id)""")
def w07_latest_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = survey_tables(spark, sf_dir).visits.select("location_id", "record_id", "visit_count")
    return latest_per_key(v, "location_id", "visit_count")


@register("w06_max_with_null_keys", """
SELECT l_orderkey, l_linenumber, NULLIF(l_suppkey % 5, 2) AS bay, l_extendedprice,
       MAX(CASE WHEN l_suppkey % 5 <> 3 THEN l_extendedprice END) OVER (PARTITION BY NULLIF(l_suppkey % 5, 2)) AS top_price
FROM lineitem""")
def w06_max_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five hot groups: one is the NULL key, one has no value at all."""
    li = load(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"])
    bay = F.col("l_suppkey") % 5
    rows = li.select("l_orderkey", "l_linenumber", F.nullif(bay, F.lit(2)).alias("bay"), "l_extendedprice",
                     F.when(bay != 3, F.col("l_extendedprice")).alias("priced"))
    return with_group_max(rows, ["bay"], "priced", "top_price").drop("priced")


@register("w07_latest_with_null_keys", """
SELECT buyer, o_orderkey, placed FROM (
    SELECT NULLIF(o_custkey, o_custkey // 3 * 3) AS buyer, o_orderkey, NULLIF(o_orderkey % 50, 49) AS placed FROM orders)
QUALIFY placed = MAX(placed) OVER (PARTITION BY buyer)""")
def w07_latest_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders share the NULL key; some have no ordinal."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    rows = o.select(F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("buyer"), "o_orderkey",
                    F.nullif(F.col("o_orderkey") % 50, F.lit(49)).alias("placed"))
    return latest_per_key(rows, "buyer", "placed")


@register("a17_share_joined_by_equals", """
WITH unplaced AS (SELECT NULLIF(c_mktsegment, 'BUILDING') AS segment, o_orderstatus, o_orderkey % 7 AS units
                  FROM orders JOIN customer ON c_custkey = o_custkey),
totals AS (SELECT segment, SUM(units) AS everything FROM unplaced GROUP BY 1)
SELECT segment, CAST(ROUND(SUM(units) FILTER (o_orderstatus = 'F') * 100.0 / any_value(everything)) AS INTEGER) AS F,
       CAST(ROUND(SUM(units) FILTER (o_orderstatus = 'O') * 100.0 / any_value(everything)) AS INTEGER) AS O
FROM unplaced JOIN totals USING (segment) GROUP BY 1""")
def a17_share_joined_by_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a group key are left out, as a join of the totals by ``=`` leaves them out."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"), "o_orderstatus",
        (F.col("o_orderkey") % 7).alias("units"))
    return pivot_share(rows, ["segment"], "o_orderstatus", ["F", "O"], "units", null_groups=False)


@register("a05_exact_average", """
SELECT p_type, CAST(k // 10000 AS VARCHAR) || '.' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') AS avg_size
FROM (SELECT p_type, (20000 * SUM(p_size) + COUNT(p_size)) // (2 * COUNT(p_size)) AS k FROM part GROUP BY 1)""")
def a05_exact_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``AVG`` of an integer column as an exact decimal with four digits (M-3)."""
    p = load(spark, sf_dir, "part", ["p_type", "p_size"])
    return p.groupBy("p_type").agg(exact_avg("p_size").cast("string").alias("avg_size"))


_MIXED = "CASE c_custkey % 3 WHEN 0 THEN lower(c_mktsegment) WHEN 1 THEN c_mktsegment ELSE initcap_(c_mktsegment) END"
_MIXED_SQL = _MIXED.replace("initcap_(c_mktsegment)", "c_mktsegment[1] || lower(c_mktsegment[2:])")


def _mixed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose segment is written in three ways, under a collation that ignores case."""
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    segment = F.expr(_MIXED.replace("initcap_", "initcap"))
    return collated(c.select("c_custkey", segment.alias("segment")), "segment")


@register("a07_group_ignoring_case", f"""
SELECT lower({_MIXED_SQL}) AS segment, COUNT(*) AS num_customers FROM customer GROUP BY 1""")
def a07_group_ignoring_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = count_by(_mixed_segments(spark, sf_dir), ["segment"], None, "num_customers")
    return grouped.select(F.lower("segment").cast("string").alias("segment"), "num_customers")


@register("f15_distinct_ignoring_case", f"SELECT DISTINCT upper({_MIXED_SQL}) AS segment FROM customer")
def f15_distinct_ignoring_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(_mixed_segments(spark, sf_dir), "segment").select(F.upper("segment").cast("string").alias("segment"))


@register("j01_join_ignoring_case", f"""
SELECT c_custkey, n_customers FROM (SELECT c_custkey, upper({_MIXED_SQL}) AS segment FROM customer)
JOIN (SELECT c_mktsegment AS segment, COUNT(*) AS n_customers FROM customer GROUP BY 1) USING (segment)""")
def j01_join_ignoring_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = collated(load(spark, sf_dir, "customer", ["c_mktsegment"]).withColumnRenamed("c_mktsegment", "segment"))
    return _mixed_segments(spark, sf_dir).join(count_by(names, ["segment"], None, "n_customers"), "segment") \
        .select("c_custkey", "n_customers")


@register("o01_order_ascending", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey")
def o01_order_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part", ["p_partkey", "p_retailprice"]).orderBy("p_retailprice", "p_partkey")


@register("o02_order_descending", """
SELECT p_type, CAST(SUM(p_size) AS BIGINT) AS total_size FROM part GROUP BY 1 ORDER BY 2 DESC""")
def o02_order_descending(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.groupBy("p_type").agg(F.sum("p_size").alias("total_size")).orderBy(F.desc("total_size"))


@register("o04_top_k", """
SELECT l_suppkey, COUNT(l_suppkey) AS num_lines FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def o04_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(load(spark, sf_dir, "lineitem", ["l_suppkey"]), "l_suppkey", 3, "num_lines")
