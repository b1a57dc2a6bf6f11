import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fieldbook.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app_name="fieldbook-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from fieldbook.sources.tables import NATIVE_TABLES, table_path

    con = duckdb.connect()
    for t in NATIVE_TABLES:
        p = table_path(SF_SMALL, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()
