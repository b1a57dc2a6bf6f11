"""Property test: the range-partitioned ranks equal Spark's windows for any data and partition count."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldbook.operators.ordered import RANGE_PARTITIONS_CONF, lead_within, rank_within

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 4))),
    min_size=0, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, parts=st.integers(1, 7), desc=st.booleans())
def test_ranks_and_lead_equal_windows(spark, rows, parts, desc):
    data = [(i, g, v) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g string, v int")
    old = spark.conf.get(RANGE_PARTITIONS_CONF, None)
    spark.conf.set(RANGE_PARTITIONS_CONF, str(parts))
    try:
        o = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_first()
        w = Window.partitionBy("g").orderBy(o)
        want = (df.withColumn("r", F.rank().over(w)).withColumn("d", F.dense_rank().over(w))
                  .withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(o, "id")))
                  .withColumn("nx", F.lead("id").over(Window.partitionBy("g").orderBy(o, "id"))))
        got = rank_within(df, ["g"], ["v"], descending=desc, tiebreak=["id"], rank="r", dense_rank="d",
                          row_number="rn")
        led = lead_within(df, ["g"], ["v"], "id", "nx", descending=desc, tiebreak=["id"])
        cols = ["id", "r", "d", "rn"]
        assert {tuple(r) for r in got.select(*cols).collect()} == {tuple(r) for r in want.select(*cols).collect()}
        assert {tuple(r) for r in led.select("id", "nx").collect()} == \
            {tuple(r) for r in want.select("id", "nx").collect()}
    finally:
        if old is None:
            spark.conf.unset(RANGE_PARTITIONS_CONF)
        else:
            spark.conf.set(RANGE_PARTITIONS_CONF, old)
