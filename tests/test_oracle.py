"""Every registered query against its DuckDB oracle on the smallest scale."""

import pytest

from compare import duck_rows, spark_rows
from conftest import SF_SMALL
from fieldbook.plans.registry import oracle_sql, queries

QUERIES = queries()
ORACLE = oracle_sql()

# Plan shapes that do not survive scale: all-pairs joins and per-row Python in the query itself.
FORBIDDEN_PLAN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def test_every_query_has_oracle_sql():
    assert set(QUERIES) == set(ORACLE)


def test_query_names_map_to_inventory_ids():
    import re

    for name in QUERIES:
        assert re.match(r"^[a-z]\d\d_[a-z0-9_]+$", name), name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got_cols, got = spark_rows(df)
    want_cols, want = duck_rows(duck, ORACLE[name])
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in FORBIDDEN_PLAN_NODES if n in plan]
