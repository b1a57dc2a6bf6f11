"""Hot keys in the joined helpers are split by adaptive execution."""

import pytest
from pyspark.sql import functions as F

from fieldbook.operators import quality, relational

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.files.maxPartitionBytes": "200k",
    "spark.sql.files.openCostInBytes": "1k",
}

HELPERS = {
    "with_group_total": lambda rows, keys: relational.with_group_total(rows, ["k"], "v", "t"),
    "with_group_max": lambda rows, keys: relational.with_group_max(rows, ["k"], "v", "t"),
    "semi": lambda rows, keys: relational.semi(rows, keys, "k"),
    "not_in": lambda rows, keys: relational.not_in(rows, keys.where("k > 50"), "k"),
    "check_reference": lambda rows, keys: quality.check_reference(rows, keys.where("k > 50"), "k"),
}


@pytest.mark.parametrize("name", HELPERS)
def test_hot_key_is_split(spark, tmp_path, name):
    path = str(tmp_path / "rows")
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 101).alias("k"),
                                      F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    rows.repartition(8).write.parquet(path)
    before = {k: spark.conf.get(k, None) for k in CONF}
    try:
        for k, v in CONF.items():
            spark.conf.set(k, v)
        stored = spark.read.parquet(path)
        out = HELPERS[name](stored, stored.select("k"))
        n = len(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert n == (60_000 if name in ("with_group_total", "with_group_max", "semi")
                 else stored.where("k <= 50").count())
    assert "skew=true" in plan
