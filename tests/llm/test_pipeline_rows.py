"""Stages of the pipeline on rows with maps, clashing names, repeated rows, nulls and no rows at all."""

import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark):
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(1, words + " one"), (1, words + " one"), (2, words + " one"), (3, "other words stand in this text, unlike the first"),
            (None, words + " one"), (None, "no id"), (4, None), (5, ""), (5, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                  "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame = frame.withColumn("tags", F.create_map(F.lit("k"), F.col("doc_id")))
    for name in ("_n", "nth", "row", "kept", "grp", "node"):
        frame = frame.withColumn(name, F.lit(name))
    return frame


def test_one_row_of_each_group_stays_with_all_columns(spark, odd):
    kept = corpus_pipeline.drop_near_duplicates(spark, odd, SMALL)
    assert kept.schema.names == odd.schema.names
    rows = kept.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, 1), (False, 3), (False, 4), (False, 5), (True, 0), (True, 0)]
    assert all(r._n == "_n" and r.nth == "nth" and r.tags == {"k": r.doc_id} for r in rows)


def test_stages_of_an_empty_table(spark, odd):
    empty = odd.where("false")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, empty, SMALL)
        assert out.schema.names == odd.schema.names and out.count() == 0


def test_groups_with_more_askers_than_a_block(spark, monkeypatch):
    """Members and askers of one group are dealt into blocks; every pair of blocks is compared."""
    from fieldbook.llm import near_dedup

    monkeypatch.setattr(near_dedup, "GROUP_BLOCK", 4)
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join([*base[:40], f"v{k}", *base[41:]])) for k in range(25)]
    rows += [(100 + k, " ".join([*base[:60], *[f"u{k}_{j}" for j in range(14)], *base[74:]])) for k in range(25)]
    rows += [(200 + k, " ".join(f"z{k}_{j}" for j in range(30))) for k in range(5)]
    sets = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs).collect()}
    assert got == root


def test_the_module_stays_importable_alone():
    assert "corpus_pipeline" in sys.modules and len(corpus_pipeline.STAGES) == 5
