"""Unit tests of the relational, cleaning and quality operators on literal frames."""

import pytest
from pyspark.sql import functions as F

from fieldbook.operators import quality, relational
from fieldbook.operators.cleaning import bad_phone_numbers, clean_contacts


def test_share_of_total_counts_and_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 4), ("c", None)], "k string, v int")
    counted = {r.k: (r.n, r.p) for r in relational.share_of_total(df, ["k"], "v", "count", "n", "p").collect()}
    assert counted == {"a": (2, 67), "b": (1, 33), "c": (0, 0)}
    summed = {r.k: (r.s, r.p) for r in relational.share_of_total(df, ["k"], "v", "sum", "s", "p").collect()}
    assert summed == {"a": (4, 50), "b": (4, 50), "c": (None, None)}


def test_share_of_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "k string, v int")
    assert {r.p for r in relational.share_of_total(df, ["k"], "v", "sum", "s", "p").collect()} == {None}


def test_pivot_share_handles_zero_groups_and_unknown_categories(spark):
    df = spark.createDataFrame([("p", "river", 10), ("p", "well", 30), ("q", "lake", 5), ("z", "well", 0)],
                               "prov string, kind string, n int")
    rows = {r.prov: (r.river, r.well) for r in relational.pivot_share(df, ["prov"], "kind", ["river", "well"], "n").collect()}
    assert rows == {"p": (25, 75), "q": (0, 0), "z": (None, None)}


def test_pivot_avg_ignores_rows_of_other_columns(spark):
    df = spark.createDataFrame([("06:00", "Sunday", 10), ("06:00", "Sunday", 21), ("06:00", "Monday", 4)],
                               "h string, d string, q int")
    day = F.col("d")
    out = relational.pivot_avg(df, "h", day, [("sunday", day.ilike("%sunday%")), ("tuesday", day.ilike("%tuesday%"))],
                               "q", "hour_of_day").first()
    assert (out.hour_of_day, out.sunday, out.tuesday) == ("06:00", 16, None)


def test_with_group_total_and_max(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    tot = {(r.k, r.v): r.t for r in relational.with_group_total(df, ["k"], "v", "t").collect()}
    assert tot == {("a", 1): 3, ("a", 2): 3, ("b", 5): 5}
    mx = {(r.k, r.v): r.m for r in relational.with_group_max(df, ["k"], "v", "m").collect()}
    assert mx == {("a", 1): 2, ("a", 2): 2, ("b", 5): 5}


def test_lookup_by_requires_at_most_one_row(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    one = spark.createDataFrame([(2,)], "k int")
    assert [r.v for r in relational.lookup_by(df, "k", one).collect()] == ["y"]
    none = spark.createDataFrame([], "k int")
    assert relational.lookup_by(df, "k", none).count() == 0
    two = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(Exception):
        relational.lookup_by(df, "k", two).collect()


def test_above_average(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 6)], "k string, n long")
    assert [r.k for r in relational.above_average(df, "n").collect()] == ["c"]


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k,) for k in [3, 3, 1, 1, 2, 2, 9]], "k int")
    assert [r.k for r in relational.top_k(df, "k", 2).collect()] == [1, 2]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "ok", "Backlog"), (1, None, "Done"), (2, "x" * 60, None)],
                               "id int, addr string, status string")
    assert [r.id for r in quality.check_unique(df, ["id"]).collect()] == [1]
    assert quality.check_not_null(df, ["addr"]).count() == 1
    assert quality.check_length(df, {"addr": 50}).count() == 1
    assert [r.status for r in quality.check_domain(df, "status", ["Backlog", "Complete"]).collect()] == ["Done"]
    ref = spark.createDataFrame([(1,)], "id int")
    assert [r.id for r in quality.check_reference(df, ref, "id").collect()] == [2]


def test_profile_relationship(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    r = quality.profile_relationship(left, right, "k").first()
    assert (r.left_rows, r.left_keys, r.left_repeated_keys) == (3, 2, 0)
    assert (r.right_rows, r.right_keys, r.right_repeated_keys, r.joined_rows) == (3, 2, 1, 2)


def test_contact_cleaning(spark):
    df = spark.createDataFrame([(" Amara Jengo ", "+99637993287 "), ("Bello Azibo", "+99643864786")],
                               "employee_name string, phone_number string")
    out = {r.employee_name: (r.email, r.phone_number) for r in clean_contacts(df, "@example.org").collect()}
    assert out[" Amara Jengo "] == ("amara.jengo@example.org", "+99637993287")
    assert bad_phone_numbers(df).count() == 0
