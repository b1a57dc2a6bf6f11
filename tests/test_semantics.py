"""MySQL behaviours the survey queries depend on, on tiny literal frames."""

from pyspark.sql import functions as F

from fieldbook.functions.exprs import byte_length, hour_label, like_ci, round_int, safe_div, safe_pct, weekday_name
from fieldbook.operators.cleaning import Fix, apply_fixes, fix_report
from fieldbook.operators.relational import not_in, semi


def test_like_ignores_case_and_underscore_needs_a_char(spark):  # M-1, F-12
    df = spark.createDataFrame([("Clean",), ("Clean Bacteria: E. coli",), ("clean_x",), (None,)], "d string")
    got = sorted(r.d for r in df.filter(like_ci("d", "clean_%")).collect())
    assert got == ["Clean Bacteria: E. coli", "clean_x"]
    assert df.filter(like_ci("d", "%BACTERIA%")).count() == 1


def test_tap_in_home_pattern_covers_broken_taps(spark):  # M-14
    df = spark.createDataFrame([("tap_in_home",), ("tap_in_home_broken",), ("river",)], "t string")
    assert df.filter(like_ci("t", "tap_in_home%")).count() == 2


def test_round_half_away_from_zero(spark):  # M-4
    df = spark.createDataFrame([(2.5,), (-2.5,), (0.5,), (1.4999,)], "x double")
    assert [r.r for r in df.select(round_int("x").alias("r")).collect()] == [3, -3, 1, 1]
    ints = spark.createDataFrame([(2749,), (2750,)], "x int")
    assert [r.r for r in ints.select(F.round("x", -2).alias("r")).collect()] == [2700, 2800]


def test_zero_divisor_gives_null(spark):  # M-5
    df = spark.createDataFrame([(1, 0), (1, 4)], "a int, b int")
    got = [r.p for r in df.select(safe_pct("a", "b").alias("p")).collect()]
    assert got == [None, 25.0]
    assert df.select(safe_div("a", "b").alias("q")).collect()[0].q is None


def test_byte_length_counts_bytes(spark):  # M-7
    df = spark.createDataFrame([("+99123456789",), ("é",)], "s string")
    assert [r.n for r in df.select(byte_length("s").alias("n")).collect()] == [12, 2]


def test_concat_with_null_is_null(spark):  # M-8
    from fieldbook.functions.exprs import concat_str

    df = spark.createDataFrame([(None,), (3,)], "n int")
    got = [r.s for r in df.select(concat_str("Install ", F.col("n"), " taps").alias("s")).collect()]
    assert got == [None, "Install 3 taps"]


def test_weekday_and_hour_labels(spark):  # X-15, X-18
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-07 05:59:00' AS ts")
    row = df.select(weekday_name("ts").alias("d"), hour_label("ts").alias("h")).first()
    assert (row.d, row.h) == ("Sunday", "05:00")


def test_three_valued_or_keeps_unmatched_rows(spark):  # M-18
    df = spark.createDataFrame([(None, "river"), (None, "well"), ("Clean", "well"), ("Bad", "well")],
                               "results string, kind string")
    got = df.filter((F.col("results") != "Clean") | F.col("kind").isin("river")).count()
    assert got == 2


def test_not_in_with_null_in_list_is_empty(spark):  # J-10
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert not_in(left, spark.createDataFrame([(1,), (None,)], "k int"), "k").count() == 0
    assert [r.k for r in not_in(left, spark.createDataFrame([(1,)], "k int"), "k").collect()] == [2]
    # an empty list keeps every row, NULL keys included
    assert not_in(left, spark.createDataFrame([], "k int"), "k").count() == 3


def test_semi_join_does_not_duplicate(spark):  # J-9
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,)], "k int")
    assert semi(left, right, "k").count() == 1


def test_updates_apply_in_order(spark):  # M-13, S-11, S-13
    df = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "c string, n int")
    fixes = [Fix("first", "c", "b", F.col("c") == "a"), Fix("second", "c", "z", F.col("c") == "b")]
    assert sorted((r.c or "") for r in apply_fixes(df, fixes).collect()) == ["", "z", "z"]
    report = {r.rule: r.affected_rows for r in fix_report(df, fixes).collect()}
    assert report == {"first": 1, "second": 2}


def test_improvement_rule_order_and_tap_count(spark):  # M-19, X-4, X-10, X-11
    from fieldbook.plans.planning import improvement

    rows = [("Contaminated: Chemical", "river", 0), ("Contaminated: Biological", "well", 0),
            (None, "river", 0), (None, "shared_tap", 29), (None, "shared_tap", 30), (None, "shared_tap", 61),
            (None, "tap_in_home_broken", 0), ("Clean", "well", 0), (None, "tap_in_home", 500)]
    df = spark.createDataFrame(rows, "results string, kind string, q int")
    got = [r.i for r in df.select(improvement(F.col("results"), F.col("kind"), F.col("q")).alias("i")).collect()]
    assert got == ["Install RO filter", "Install UV and RO filter", "Drill well", None, "Install 1 tap nearby",
                   "Install 2 taps nearby", "Diagnose local infrastructure", None, None]


def test_nulls_sort_first_ascending_last_descending(spark):  # M-6
    from fieldbook.operators.ordered import rank_within

    df = spark.createDataFrame([(1, None), (2, 5), (3, 7)], "id int, v int")
    asc = {r.id: r.r for r in rank_within(df, [], ["v"], rank="r", tiebreak=["id"]).collect()}
    desc = {r.id: r.r for r in rank_within(df, [], ["v"], descending=True, rank="r", tiebreak=["id"]).collect()}
    assert asc == {1: 1, 2: 2, 3: 3} and desc == {3: 1, 2: 2, 1: 3}


def test_case_insensitive_equality(spark):  # M-2
    from fieldbook.functions.exprs import eq_ci

    df = spark.createDataFrame([("Clean",), ("CLEAN",), ("Clean Bacteria",), (None,)], "r string")
    assert df.filter(eq_ci("r", "clean")).count() == 2
