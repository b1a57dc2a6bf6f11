"""Training-data pipeline over ``documents``: five operators, each stage written before the next reads it.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.  All but
the last return the columns of documents; the last adds ``copy``, the number of the copy.

A null text is the empty text and a null id an id of its own: such rows pass the filters on their text, are never
near-duplicates of anything, and are redacted and mixed like others.  Of rows that repeat an id and a text one stays after
the near-duplicate stage, the first by all its columns as JSON.  Columns beyond those of documents, of any type and
name, are carried along.  An empty table gives an empty result, and without labels nothing is rejected.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbook.llm import decontamination, mixing, near_dedup, pii, quality_classifier
from fieldbook.llm.storage import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The driver keeps a description of each of the last thousand plans; those of this pipeline are long.
PLAN_TEXT = {"spark.sql.ui.explainMode": "simple", "spark.sql.maxPlanStringLength": "4000"}


def _short_plans(stage):
    """``stage`` with short plan descriptions, unless the session says otherwise."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        said = spark.sparkContext.getConf()
        for key, value in PLAN_TEXT.items():
            if not said.contains(key):
                spark.conf.set(key, value)
        return stage(spark, docs, sf_dir)
    return run_stage


@_short_plans
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_classifier.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_classifier.keep_accepted(docs, model) if model else docs


@_short_plans
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id; of repeated rows one."""
    kept = near_dedup.near_duplicates(docs.select("doc_id", "text")).where("kept and doc_id is not null").select("doc_id").distinct()
    whole = F.struct(*docs.columns).alias("row")
    known = docs.select("doc_id", whole).join(kept, "doc_id", "left_semi")
    # The window's keys begin with the join's, so the rows are not shuffled again.
    same = Window.partitionBy("doc_id", "row.text").orderBy(F.to_json("row"))
    first = known.select("row", F.row_number().over(same).alias("nth")).where("nth = 1").select("row.*")
    return first.union(docs.where("doc_id is null"))


@_short_plans
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


@_short_plans
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; n_chars is that of the new text."""
    return pii.redact_documents(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


@_short_plans
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document once per copy, with the copy's number."""
    return mixing.emit_mix(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal data", redact_personal_data),
    ("mix", mix_sources),
]

#: The classifier and the contextual patterns are trained, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is stored and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        scratch.tidy()
    return docs
