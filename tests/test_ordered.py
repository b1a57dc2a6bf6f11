"""Skew-safe ordinals, ranks and next values agree with Spark's window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldbook.operators.ordered import (RANGE_PARTITIONS_CONF, lead_within, rank_within, row_number_within,
                                        running_total)


@pytest.fixture(autouse=True)
def explicit_range_partitions(spark):
    """Fixed range partitions, as on a cluster: groups and tie runs really cross partition boundaries.

    (Without it, adaptive execution merges the tiny test inputs into one task.)
    """
    spark.conf.set(RANGE_PARTITIONS_CONF, "8")
    yield
    spark.conf.unset(RANGE_PARTITIONS_CONF)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        # one key holds about a third of the rows; a few NULL keys; many ties in v
        g = "hot" if rng.random() < 0.34 else (None if rng.random() < 0.02 else f"g{rng.randint(0, 40)}")
        rows.append((i, g, rng.randint(0, 20), rng.random()))
    return spark.createDataFrame(rows, "id long, g string, v int, w double").repartition(5)


def _as_set(df, cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_row_number_matches_window(skewed):
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), "id")
    want = skewed.withColumn("rn", F.row_number().over(w))
    got = row_number_within(skewed, ["g"], ["v"], "rn", descending=True, tiebreak=["id"])
    assert _as_set(got, ["id", "rn"]) == _as_set(want, ["id", "rn"])


def test_ranks_match_window(skewed):
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    want = skewed.withColumn("r", F.rank().over(w)).withColumn("d", F.dense_rank().over(w))
    got = rank_within(skewed, ["g"], ["v"], descending=True, tiebreak=["id"], rank="r", dense_rank="d")
    assert _as_set(got, ["id", "r", "d"]) == _as_set(want, ["id", "r", "d"])


def test_global_rank_without_partition(skewed):
    w = Window.orderBy("v")
    want = skewed.withColumn("r", F.rank().over(w))
    got = rank_within(skewed, [], ["v"], tiebreak=["id"], rank="r")
    assert _as_set(got, ["id", "r"]) == _as_set(want, ["id", "r"])


def test_weighted_running_sum(skewed):
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("s", F.round(F.sum("w").over(w), 6))
    got = running_total(skewed, ["g"], ["id"], "s", weight="w").withColumn("s", F.round("s", 6))
    assert _as_set(got, ["id", "s"]) == _as_set(want, ["id", "s"])


def test_lead_matches_window(skewed):
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), "id")
    want = skewed.withColumn("nx", F.lead("v").over(w))
    got = lead_within(skewed, ["g"], ["v"], "v", "nx", descending=True, tiebreak=["id"])
    assert _as_set(got, ["id", "nx"]) == _as_set(want, ["id", "nx"])


def test_lead_global(skewed):
    w = Window.orderBy("v", "id")
    want = skewed.withColumn("nx", F.lead("id").over(w))
    got = lead_within(skewed, [], ["v"], "id", "nx", tiebreak=["id"])
    assert _as_set(got, ["id", "nx"]) == _as_set(want, ["id", "nx"])


def test_empty_input(spark):
    empty = spark.createDataFrame([], "id long, g string, v int")
    assert row_number_within(empty, ["g"], ["v"], "rn").count() == 0


def test_tie_run_spanning_many_partitions_and_batches(spark):
    # one group, one order value for most rows: a tie run covering whole range partitions
    rows = [(i, "g" if i % 10 else "h", 5 if i < 2500 else i % 7, None if i % 97 == 0 else i % 3)
            for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, g string, v int, n int")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for order, desc in ((["v"], True), (["v", "n"], False)):
            spec = [F.col(c).desc() if desc else F.col(c).asc() for c in order]
            w = Window.partitionBy("g").orderBy(*spec)
            want = (df.withColumn("r", F.rank().over(w)).withColumn("d", F.dense_rank().over(w))
                      .withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*spec, "id"))))
            got = rank_within(df, ["g"], order, descending=desc, tiebreak=["id"], rank="r", dense_rank="d",
                              row_number="rn")
            assert _as_set(got, ["id", "r", "d", "rn"]) == _as_set(want, ["id", "r", "d", "rn"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_range_stage_spreads_a_hot_group(spark):
    from fieldbook.operators.ordered import range_sorted

    # location 7 holds a third of the visits
    rows = [(i, 7 if i % 3 == 0 else i % 500, i * 13 % 10007) for i in range(30000)]
    df = spark.createDataFrame(rows, "record_id long, location_id long, t long")
    staged = range_sorted(df, ["location_id"], ["t"], tiebreak=["record_id"])
    per_part = staged.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("location_id") == 7, 1).otherwise(0)).alias("hot"))
    parts = per_part.collect()
    n_parts = int(spark.conf.get(RANGE_PARTITIONS_CONF))
    assert max(r.n for r in parts) < 2.0 * 30000 / n_parts          # no partition holds the hot group
    assert sum(1 for r in parts if r.hot > 0) >= n_parts // 3       # the hot group spans several partitions


def test_exact_above_double_precision(spark):
    """Keys, values and payload that a double or nanoseconds cannot hold stay as they are."""
    import datetime as dt
    import decimal

    base = 2 ** 53
    rows = [(base + i // 2, base + 2 * i + 1 if i % 7 else None, float("nan") if i % 3 else None,
             decimal.Decimal(i) / 7, dt.datetime(3000, 1, 1) + dt.timedelta(days=i), i) for i in range(60)]
    df = spark.createDataFrame(rows, "g long, v long, x double, d decimal(38,18), t timestamp_ntz, id long")
    order = Window.partitionBy("g").orderBy(F.col("id").desc())
    want = df.withColumns({"n": F.row_number().over(order), "nx": F.lead("v").over(order)})
    lead = lead_within(df, ["g"], ["id"], "v", "nx", descending=True)
    got = rank_within(lead, ["g"], ["id"], descending=True, row_number="n")
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
    whole = Window.orderBy("g", "id")
    ranked = rank_within(df, [], ["g"], tiebreak=["id"], rank="r", dense_rank="dr", row_number="n")
    expect = df.withColumns({"r": F.rank().over(Window.orderBy("g")), "dr": F.dense_rank().over(Window.orderBy("g")),
                             "n": F.row_number().over(whole)})
    assert sorted(map(repr, ranked.select(expect.columns).collect())) == sorted(map(repr, expect.collect()))


def test_lead_across_tiny_batches_and_partitions(spark):
    rows = [(i, "g" if i % 5 else None, i % 11) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g string, v int")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        w = Window.partitionBy("g").orderBy(F.col("v").desc(), "id")
        want = df.withColumn("nx", F.lead("id").over(w))
        got = lead_within(df, ["g"], ["v"], "id", "nx", descending=True, tiebreak=["id"])
        assert _as_set(got, ["id", "nx"]) == _as_set(want, ["id", "nx"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_running_sum_with_signed_weights(spark):
    rows = [(i, "g" if i % 4 else "h", float((i * 37) % 11 - 5)) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, g string, w double")
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("s", F.round(F.sum("w").over(w), 6))
    got = running_total(df, ["g"], ["id"], "s", weight="w").withColumn("s", F.round("s", 6))
    assert _as_set(got, ["id", "s"]) == _as_set(want, ["id", "s"])


def test_adaptive_range_partitions_give_the_same_ranks(skewed, spark):
    spark.conf.unset(RANGE_PARTITIONS_CONF)   # default mode: adaptive execution sizes the range partitions
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    want = skewed.withColumn("r", F.rank().over(w)).withColumn("d", F.dense_rank().over(w))
    got = rank_within(skewed, ["g"], ["v"], descending=True, tiebreak=["id"], rank="r", dense_rank="d")
    assert _as_set(got, ["id", "r", "d"]) == _as_set(want, ["id", "r", "d"])
