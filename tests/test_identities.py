"""Cross-checks the reference itself relies on: the same answer by a second route."""

import duckdb
from pyspark.sql import functions as F

from conftest import SF_CHECK
from fieldbook.operators.cleaning import mislabelled, pollution_fixes, apply_fixes
from fieldbook.plans import audit, planning, registry, survey
from fieldbook.plans.registry import queries
from fieldbook.sources.roles import survey_tables
from fieldbook.sources.schemas import QUEUE_PIVOT_COLUMNS
from fieldbook.sources.tables import NATIVE_TABLES, table_path

Q = queries()


def _keys(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def expected(name):
    """Rows of a query's oracle over the same data."""
    con = duckdb.connect()
    for t in NATIVE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_CHECK, t)}')")
    return con.execute(f"SELECT COUNT(*) FROM ({registry.oracle_sql()[name]})").fetchone()[0]


def test_top_k_formulations_agree(spark):
    a = _keys(Q["k04_top_k_profile"](spark, SF_CHECK), "employee_name", "email", "phone_number")
    b = _keys(Q["k04_top_k_in"](spark, SF_CHECK), "employee_name", "email", "phone_number")
    c = Q["j06_comma_join"](spark, SF_CHECK)
    d = Q["o04_top_k"](spark, SF_CHECK)
    assert a == b and len(a) == 3
    assert _keys(c, "s_suppkey") == _keys(d, "l_suppkey")


def test_first_visit_matches_plus_mismatches_equal_audited_first_visits(spark):
    t = survey_tables(spark, SF_CHECK)
    equal = audit.audit_scores(t, True, True).count()
    unequal = audit.audit_scores(t, False, True).count()
    assert equal + unequal == audit.audit_scores(t, None, True).count()
    assert (equal, unequal) == (expected("k18_equal_first_visit"), expected("k18_unequal_first_visit"))


def test_cash_evidence_splits_between_suspects_and_others(spark):
    inc = audit.incorrect_records(survey_tables(spark, SF_CHECK))
    sus = audit.evidence(inc, "%cash%", True).count()
    other = audit.evidence(inc, "%cash%", False).count()
    total = inc.filter(F.col("statements").ilike("%cash%")).count()
    assert (sus, other) == (expected("k23_suspect_cash"), expected("k23_non_suspect_cash")) and sus + other == total > 0
    assert audit.suspects(inc).count() == expected("k22_suspects")


def test_no_mislabelled_rows_after_repair(spark):
    wp = survey_tables(spark, SF_CHECK).well_pollution
    assert mislabelled(wp).count() > 0
    assert mislabelled(apply_fixes(wp, pollution_fixes())).count() == 0


def test_pivot_equals_long_form(spark):
    v = survey_tables(spark, SF_CHECK).visits
    pivot = {r.hour_of_day: r.sunday for r in survey.queue_pivot(v).collect()}
    long = Q["k12_queue_long"](spark, SF_CHECK).filter(F.col("sunday").isNotNull())
    avg = long.groupBy("hour_of_day").agg(F.round(F.avg("sunday")).cast("int").alias("s"))
    assert pivot == {r.hour_of_day: r.s for r in avg.collect()}


def test_pivot_header_matches_golden_file(spark):
    assert tuple(Q["k12_queue_pivot"](spark, SF_CHECK).columns) == QUEUE_PIVOT_COLUMNS


def test_rows_inserted_equal_rows_planned(spark):
    t = survey_tables(spark, SF_CHECK)
    plan = planning.improvement_plan(t)
    progress = planning.project_progress(plan)
    assert progress.count() == plan.count() == expected("k27_improvement_plan")
    assert progress.select("Project_id").distinct().count() == plan.count()
    assert planning.progress_violations(progress).count() == 0
    assert {r.Source_status for r in progress.select("Source_status").distinct().collect()} == {"Backlog"}


def test_number_of_equal_scores_on_latest_visits(spark):
    assert Q["k19_audit_latest"](spark, SF_CHECK).count() == expected("k19_audit_latest")


def test_zero_divisor_towns_give_null(spark):
    pct = Q["k26_broken_tap_pct"](spark, SF_CHECK)
    assert pct.filter(F.col("Pct_broken_taps").isNull()).count() == 2
