"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

from conftest import ROOT


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_flagship_query(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["type_of_water_source", "num_of_sources", "avg_served", "population_served",
                          "percentage_people_per_source", "rank_by_population"]


def test_queries_and_oracle_keys_align():
    mod = _entry_module()
    without = set(mod.queries()) - set(mod.oracle_sql())
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert all(name == "pipeline" or name.startswith("op") for name in without)
    assert len(mod.queries()) >= 100
