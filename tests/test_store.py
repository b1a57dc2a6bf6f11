"""Owners of stored tables, observed inserts, stored order, exact decimals and collated keys."""

import decimal
import os
import random

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fieldbook.functions.exprs import exact_avg, exact_div
from fieldbook.operators import relational, windows
from fieldbook.plans import planning, registry
from fieldbook.session import checkpoint_dir
from fieldbook.sources import io, schemas
from fieldbook.sources.roles import survey_tables
from fieldbook.sources.store import current_store, owned, session_store

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def stored(spark):
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


# --- owners ----------------------------------------------------------------------------------------

@pytest.mark.parametrize("key", ["s06_snapshot_part", "w02_rank_within_partition", "w05_lead_gap", "j08_group_total",
                                 "k09_priority_ranks", "k21_mistake_gap", "k25_province_access"])
def test_nothing_is_left_after_an_owned_run(spark, key):
    registry.queries()[key](spark, SF_SMALL).count()  # what lives as long as the session is stored by now
    before = stored(spark)
    with owned(spark):
        assert registry.queries()[key](spark, SF_SMALL).count() > 0
    assert stored(spark) == before


def test_release_removes_one_table(spark):
    before = stored(spark)
    copy = io.snapshot(spark.range(5), "released")
    assert len(stored(spark) - before) == 1 and copy.count() == 5
    current_store(spark).release(copy)
    assert stored(spark) == before


def test_kept_frames_are_given_back(spark):
    with owned(spark) as store:
        kept = io.materialise(spark.range(7), "fb_kept")
        assert kept.is_cached and spark.table("fb_kept").count() == 7
        again = io.materialise(spark.range(8), "fb_kept")
        assert not kept.is_cached and again.count() == 8
        assert store is current_store(spark) is not session_store(spark)
    assert not again.is_cached and not spark.catalog.tableExists("fb_kept")


def test_survey_tables_outlive_the_block_that_built_them(spark, tmp_path):
    link = tmp_path / "sf"
    os.symlink(SF_SMALL, link)
    with owned(spark):
        t = survey_tables(spark, str(link))
        n = t.visits.count()
    assert t.visits.count() == n


def test_a_session_leaves_no_tables_behind(tmp_path):
    """The command line in a process of its own: the shared folder has no table after it."""
    import subprocess
    import sys

    code = ("import sys; from pyspark.sql import SparkSession; "
            f"SparkSession.builder.master('local[2]').config('spark.checkpoint.dir', '{tmp_path}/shared')"
            ".config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4').getOrCreate(); "
            f"from fieldbook.__main__ import main; sys.exit(main(['run', 'k21_mistake_gap', '--sf', '{SF_SMALL}', '--out', '{tmp_path}/out']))")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert any(f.endswith(".parquet") for f in os.listdir(tmp_path / "out"))
    left = [f for _, _, files in os.walk(tmp_path / "shared") for f in files]
    assert left == []


# --- NULL keys -------------------------------------------------------------------------------------

rows_with_nulls = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 9))), max_size=25)


@SETTINGS
@given(rows=rows_with_nulls)
def test_group_max_and_latest_equal_the_window(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, k int, o int")
    top = F.max("o").over(Window.partitionBy("k"))
    want = df.withColumn("m", top)
    assert sorted(map(tuple, relational.with_group_max(df, ["k"], "o", "m").collect()), key=repr) == \
        sorted(map(tuple, want.collect()), key=repr)
    assert sorted(map(tuple, windows.latest_per_key(df, "k", "o").collect()), key=repr) == \
        sorted(map(tuple, want.where("o = m").drop("m").collect()), key=repr)


def test_null_key_joins_are_split(spark, tmp_path):
    """A third of the rows without a key: the null-safe join is still split by adaptive execution."""
    from test_skew import CONF

    path = str(tmp_path / "rows")
    spark.range(60_000).select(F.when(F.col("id") % 3 != 0, F.col("id") % 101).alias("k"), F.col("id").alias("v"),
                               (F.col("id") % 2).alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("pad")).repartition(8).write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        df = spark.read.parquet(path)
        for out, n in ((relational.with_group_max(df, ["k"], "v", "m"), 60_000), (windows.latest_per_key(df, "k", "t"), 30_000)):
            assert len(out.collect()) == n
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_shares_of_unplaced_groups(spark):
    df = spark.createDataFrame([("p", "river", 1), ("p", "well", 3), (None, "river", 5), ("q", None, 2)], "g string, c string, n int")
    rows = relational.pivot_share(df, ["g"], "c", ["river", "well"], "n", null_groups=False).collect()
    assert sorted(map(tuple, rows)) == [("p", 25, 75), ("q", 0, 0)]
    assert len(relational.pivot_share(df, ["g"], "c", ["river"], "n").collect()) == 3
    unplaced = spark.createDataFrame([(None, "t", "river", 4), ("p", None, "river", 4), ("p", "t", "river", 4)],
                                     "province_name string, town_name string, source_type string, people_served int")
    assert [r.province_name for r in planning.province_access(unplaced).collect()] == ["p"]
    assert [(r.province_name, r.town_name) for r in planning.town_access(unplaced).collect()] == [("p", "t")]


# --- J-7, J-8 --------------------------------------------------------------------------------------

@pytest.mark.parametrize("key", ["j07_composite_key_join", "j08_group_total"])
def test_group_totals_read_each_input_once(spark, key):
    with owned(spark):
        plan = registry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "location_id" not in plan  # the stored detail only


# --- S-10 ------------------------------------------------------------------------------------------

def progress_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "source_id string, Address string, Town string, Source_status string")


def insert(df, path):
    return io.insert_into(df, path, schemas.PROJECT_PROGRESS, schemas.PROJECT_PROGRESS_DEFAULTS, "Project_id",
                          rules=planning.progress_rules())


def test_insert_counts_broken_rules_in_the_write_and_writes_nothing(spark):
    before = stored(spark)
    path = io.shared_path(spark, "observed")
    good = progress_rows(spark, ("1", "a", "t", "Backlog"), ("2", "b", None, None))
    assert insert(good, path).count() == 2
    held = sorted(map(tuple, spark.read.parquet(path).collect()), key=repr)
    bad = progress_rows(spark, (None, "a", "t", "Backlog"), ("3", "x" * 51, "t" * 31, "Gone"), ("4", "ok", "t", "Gone"))
    with pytest.raises(ValueError, match=r"'not_null': 1.*'length': 1.*'domain': 2"):
        insert(bad, path)
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=repr) == held
    assert len(stored(spark) - before) == 1  # the table itself, no staged copy


def test_insert_returns_the_stored_rows_with_ids_going_on(spark):
    path = io.shared_path(spark, "observed")
    first = insert(progress_rows(spark, ("1", "a", "t", "Backlog")), path)
    empty = insert(progress_rows(spark, ("1", "a", "t", "Backlog")).where("false"), path)
    second = insert(progress_rows(spark, ("2", "a", "t", "Complete"), ("3", "a", "t", "Backlog")).repartition(2), path)
    assert (first.count(), empty.count(), second.count()) == (1, 0, 2)
    ids = [r.Project_id for r in first.union(second).collect()]
    assert len(set(ids)) == 3 and max(r.Project_id for r in first.collect()) < min(r.Project_id for r in second.collect())
    assert sorted(r.Project_id for r in spark.read.parquet(path).collect()) == sorted(ids)


# --- M-3 -------------------------------------------------------------------------------------------

def plain_div(n, d, scale):
    if not d:
        return None
    with decimal.localcontext() as c:
        c.prec = 80
        return (decimal.Decimal(n) / decimal.Decimal(d)).quantize(decimal.Decimal(1).scaleb(-scale), decimal.ROUND_HALF_UP)


def test_exact_division_has_mysql_scale(spark):
    rng = random.Random(4)
    rows = [(1, 3), (2, 3), (-1, 8), (1, 80000), (-1, 80000), (1, 0), (0, 5), (10 ** 17, 7), (-(10 ** 17), 10 ** 17 - 1), (1, 16)]
    rows += [(rng.randrange(-10 ** 6, 10 ** 6), rng.randrange(-999, 999)) for _ in range(200)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n bigint, d bigint")
    out = df.select("i", exact_div("n", "d").alias("q"), exact_div(F.col("n").cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)"),
                                                                  "d", num_scale=2).alias("q2")).orderBy("i").collect()
    assert out[0].q == decimal.Decimal("0.3333") and out[0].q2.as_tuple().exponent == -6
    for r, (n, d) in zip(out, rows, strict=True):
        assert r.q == plain_div(n, d, 4), (n, d)
        assert r.q2 == plain_div(decimal.Decimal(n) / 100, d, 6), (n, d)


def test_exact_average(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, None), (3, 2 ** 31 - 1), (3, 0)], "k int, v int")
    got = {r.k: r.a for r in df.groupBy("k").agg(exact_avg("v").alias("a")).collect()}
    assert got == {1: decimal.Decimal("1.6667"), 2: None, 3: decimal.Decimal("1073741823.5000")}


# --- M-2 -------------------------------------------------------------------------------------------

def test_collated_keys_ignore_case_in_joins_groups_and_distinct(spark):
    left = schemas.collated(spark.createDataFrame([(1, "River"), (2, "RIVER"), (3, "well"), (4, None)], "id int, k string"))
    right = schemas.collated(spark.createDataFrame([("river", 7), ("WELL", 8), (None, 9)], "k string, v int"))
    assert sorted((r.id, r.v) for r in left.join(right, "k").collect()) == [(1, 7), (2, 7), (3, 8)]
    assert sorted(r["count"] for r in left.groupBy("k").count().collect()) == [1, 1, 2]
    assert relational.distinct_values(left, "k").count() == 3
    assert relational.semi(left, right.where("v = 7"), "k").count() == 2
    assert relational.not_in(left, right.where("v = 7"), "k").count() == 1
    assert left.where(F.col("k").isin("rIVER")).count() == 2
    assert {r.m for r in relational.with_group_max(left, ["k"], "id", "m").where("lower(k) = 'river'").collect()} == {2}
    assert {r.k for r in left.collect()} == {"River", "RIVER", "well", None}


# --- O-1..O-3 --------------------------------------------------------------------------------------

# Sort columns of each ordered result; a leading minus is descending (NULLs then last, M-6).
ORDERS = {"o01_order_ascending": ["p_retailprice", "p_partkey"], "o02_order_descending": ["-total_size"],
          "a08_group_several_keys": ["r_name", "-num_customers"], "k25_province_access": ["province_name"],
          "k26_town_access": ["town_name"], "k26_broken_tap_pct": ["-Pct_broken_taps"]}


def stored_order(spark, df, name):
    path = io.shared_path(spark, name)
    io.write_sorted(df, path)
    return io.read_sorted(spark, path).collect()


@pytest.mark.parametrize("key", ORDERS)
def test_results_are_stored_in_order(spark, duck, key):
    rows = stored_order(spark, registry.queries()[key](spark, SF_SMALL), "ordered")
    names = [c.lstrip("-") for c in ORDERS[key]]
    by = ", ".join(f"{c[1:]} DESC NULLS LAST" if c[0] == "-" else f"{c} NULLS FIRST" for c in ORDERS[key])
    want = duck.execute(f"SELECT {', '.join(names)} FROM ({registry.oracle_sql()[key]}) ORDER BY {by}").fetchall()
    rows.sort(key=lambda r: (r.file_place, r.row_place))
    assert [tuple(r[c] for c in names) for r in rows] == want


def test_order_with_ties_and_nulls_over_many_files(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for i in range(4000)]
    df = spark.createDataFrame(rows, "id int, n int, s string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = stored_order(spark, df.orderBy("s", F.desc("n"), "id"), "ties")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.file_place for r in got}) > 3
    got.sort(key=lambda r: (r.file_place, r.row_place))
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id INT, n INT, s VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    assert [(r.id, r.n, r.s) for r in got] == con.execute(
        "SELECT * FROM t ORDER BY s NULLS FIRST, n DESC NULLS LAST, id").fetchall()
