"""Sources and sinks: CSV import/export, declared schemas, views, snapshots, inserts (S-3..S-10)."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fieldbook.plans import survey
from fieldbook.sources import io, schemas
from fieldbook.sources.roles import survey_tables
from fieldbook.sources.tables import load, preview


def test_csv_round_trip_of_the_pivot(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="fb-csv-"), "queue_pivot")
    pivot = survey.queue_pivot(survey_tables(spark, SF_SMALL).visits)
    io.write_csv(pivot, out, single_file=True)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    with open(os.path.join(out, files[0])) as fh:
        assert fh.readline().strip() == ",".join(schemas.QUEUE_PIVOT_COLUMNS)
    schema = "hour_of_day string, " + ", ".join(f"{d} int" for d in schemas.QUEUE_PIVOT_COLUMNS[1:])
    back = spark.read.schema(schema).option("header", True).csv(out)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pivot.collect()))


def test_read_csv_into_declared_schema(spark):
    d = tempfile.mkdtemp(prefix="fb-audit-")
    path = os.path.join(d, "auditor_report.csv")
    with open(path, "w") as fh:
        fh.write("location_id,type_of_water_source,true_water_source_score,statements\n")
        fh.write("LOC00103,well,7,No concerns\n")
        fh.write("LOC04508,river,,Villagers mentioned Cash exchange\n")
    df = io.read_csv(spark, path, schemas.AUDITOR_REPORT)
    assert df.schema == schemas.AUDITOR_REPORT
    rows = {r.location_id: r.true_water_source_score for r in df.collect()}
    assert rows == {"LOC00103": 7, "LOC04508": None}


def test_views_register_and_drop(spark):
    df = load(spark, SF_SMALL, "region")
    io.register_view(df, "fb_region_view")
    assert spark.sql("SELECT COUNT(*) AS n FROM fb_region_view").first().n == 5
    assert io.drop_view(spark, "fb_region_view") is True
    assert io.drop_view(spark, "fb_region_view") is False


def test_snapshot_is_an_independent_copy(spark):
    part = load(spark, SF_SMALL, "part")
    copy = io.snapshot(part, "part_copy_test")
    assert copy.count() == part.count()
    assert sorted(map(tuple, copy.collect())) == sorted(map(tuple, part.collect()))


def test_materialise_registers_a_cached_view(spark):
    df = io.materialise(load(spark, SF_SMALL, "nation"), "fb_nation_tmp")
    assert df.is_cached and spark.table("fb_nation_tmp").count() == 25
    df.unpersist()


def test_append_with_defaults_and_write(spark):
    rows = spark.createDataFrame([(1, "addr", "Improvement A")], "source_id long, Address string, Improvement string")
    out = io.append_with_defaults(rows, schemas.PROJECT_PROGRESS, schemas.PROJECT_PROGRESS_DEFAULTS, "Project_id")
    assert out.schema.names == schemas.PROJECT_PROGRESS.names
    r = out.first()
    assert (r.source_id, r.Source_status, r.Date_of_completion, r.Comments) == ("1", "Backlog", None, None)
    path = io.shared_path(spark, "project_progress")
    io.write_table(out, path, "append")
    io.write_table(out, path, "append")
    assert spark.read.parquet(path).count() == 2


def test_preview_has_at_most_n_rows(spark):
    assert preview(load(spark, SF_SMALL, "nation"), 10).count() == 10


def test_scan_prunes_columns_and_pushes_filters(spark):
    df = load(spark, SF_SMALL, "lineitem").filter(F.col("l_quantity") > 45).select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_survey_views_accept_sql(spark):
    from fieldbook import register_survey_views

    names = register_survey_views(spark, SF_SMALL)
    assert "visits" in names
    first = spark.sql("SELECT COUNT(*) AS n FROM visits WHERE visit_count = 1").first().n
    locations = spark.sql("SELECT COUNT(DISTINCT location_id) AS n FROM visits").first().n
    assert first == locations
    wells = spark.sql("SELECT COUNT(*) AS n FROM water_source WHERE type_of_water_source ILIKE '%well%'").first().n
    assert wells == spark.sql("SELECT COUNT(*) AS n FROM well_pollution").first().n


def test_command_line_runs_and_exports(spark, capsys):
    from fieldbook.__main__ import main

    assert main(["list"]) == 0
    assert "k12_queue_pivot" in capsys.readouterr().out
    out = io.shared_path(spark, "cli_pivot")
    assert main(["run", "k12_queue_pivot", "--sf", SF_SMALL, "--out", out, "--format", "csv"]) == 0
    assert spark.read.option("header", True).csv(out).count() == 24


def test_progress_inserts_keep_ids_unique(spark):
    from fieldbook.plans import planning

    t = survey_tables(spark, SF_SMALL)
    plan = planning.improvement_plan(t)
    path = io.shared_path(spark, "project_progress_inserts")
    planning.save_progress(plan, path)
    planning.save_progress(plan, path)
    stored = spark.read.parquet(path)
    n = plan.count()
    assert stored.count() == 2 * n
    assert stored.select("Project_id").distinct().count() == 2 * n
    assert stored.agg(F.min("Project_id")).first()[0] == 1
    assert {r.Source_status for r in stored.select("Source_status").distinct().collect()} == {"Backlog"}


def test_insert_refuses_rows_that_break_a_constraint(spark):
    import pytest

    rows = spark.createDataFrame([(None, "x")], "source_id string, Address string")
    path = io.shared_path(spark, "bad_progress")
    from fieldbook.plans.planning import progress_violations
    with pytest.raises(ValueError):
        io.insert_into(rows, path, schemas.PROJECT_PROGRESS, schemas.PROJECT_PROGRESS_DEFAULTS, "Project_id",
                       check=progress_violations)


def test_data_dictionary_lists_every_survey_column(spark):
    from fieldbook.sources.roles import data_dictionary

    dd = {(r.table_name, r.column_name): r.data_type for r in data_dictionary(spark, SF_SMALL).collect()}
    assert dd[("visits", "visit_count")] == "int"
    assert dd[("auditor_report", "true_water_source_score")] == "int"
    assert dd[("well_pollution", "biological")] == "double"
    assert len({t for t, _ in dd}) == 8
