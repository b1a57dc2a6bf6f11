"""Property tests: NULL-sensitive relational operators agree with DuckDB's SQL on random tables."""

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from compare import rows_of, spark_rows
from fieldbook.operators import relational

keys = st.one_of(st.none(), st.integers(0, 5))
left_rows = st.lists(st.tuples(st.integers(0, 10_000), keys), min_size=0, max_size=25)
right_rows = st.lists(keys, min_size=0, max_size=10)
SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _duck(sql, **frames):
    con = duckdb.connect()
    for name, pdf in frames.items():
        con.register(name, pdf)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return sorted(cols), rows_of(cols, cur.fetchall())


@SETTINGS
@given(left=left_rows, right=right_rows)
def test_not_in_and_semi_match_sql(spark, left, right):
    lp = pd.DataFrame({"id": [r[0] for r in left], "k": pd.array([r[1] for r in left], dtype="Int64")})
    rp = pd.DataFrame({"k": pd.array(right, dtype="Int64")})
    ldf = spark.createDataFrame([(r[0], r[1]) for r in left], "id long, k long")
    rdf = spark.createDataFrame([(k,) for k in right], "k long")
    assert spark_rows(relational.not_in(ldf, rdf, "k")) == \
        _duck("SELECT id, k FROM l WHERE k NOT IN (SELECT k FROM r)", l=lp, r=rp)
    assert spark_rows(relational.semi(ldf, rdf, "k")) == \
        _duck("SELECT id, k FROM l WHERE k IN (SELECT k FROM r)", l=lp, r=rp)


cats = st.sampled_from(["river", "well", "lake", None])
groups = st.sampled_from(["p", "q", None])
measures = st.one_of(st.none(), st.integers(0, 50))
detail = st.lists(st.tuples(groups, cats, measures), min_size=0, max_size=30)


@SETTINGS
@given(rows=detail)
def test_pivot_share_and_share_of_total_match_sql(spark, rows):
    pdf = pd.DataFrame({"g": [r[0] for r in rows], "c": [r[1] for r in rows],
                        "m": pd.array([r[2] for r in rows], dtype="Int64")})
    df = spark.createDataFrame(rows, "g string, c string, m long")
    pivot_sql = """
        SELECT g,
               CAST(ROUND(SUM(CASE WHEN c = 'river' THEN m ELSE 0 END) * 100.0 / NULLIF(SUM(m), 0), 0) AS INTEGER) AS river,
               CAST(ROUND(SUM(CASE WHEN c = 'well' THEN m ELSE 0 END) * 100.0 / NULLIF(SUM(m), 0), 0) AS INTEGER) AS well
        FROM t GROUP BY g"""
    assert spark_rows(relational.pivot_share(df, ["g"], "c", ["river", "well"], "m")) == _duck(pivot_sql, t=pdf)
    share_sql = """
        SELECT c, SUM(m) AS s,
               CAST(ROUND(SUM(m) / NULLIF((SELECT SUM(m) FROM t), 0) * 100) AS INTEGER) AS p
        FROM t GROUP BY c"""
    assert spark_rows(relational.share_of_total(df, ["c"], "m", "sum", "s", "p")) == _duck(share_sql, t=pdf)
