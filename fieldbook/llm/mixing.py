"""Operator 5: mix sources to target weights by systematic sampling.

Every document of a source gets the same expected number of copies, the source's
target over its size.  The documents of a source are put in order of size; the prefix
sum of the expected copies, shifted by one random offset of the source, crosses an
integer boundary once for every copy that the document gives.  Because the crossings
so far never differ from their expectation by one, the words taken from a source
differ from its target by less than the longest document.

Order and prefix sums are computed in range partitions: a source that holds a third
of all rows spans many tasks, and a table with a row per (partition, source) carries
the offsets.  Text is never shuffled to decide the copies.

Edge cases.  A null or blank text has size 0 and takes nothing, though it may get
copies.  A null source is a source of its own, the last in order.  Repeated rows are
separate documents.  An empty table gives an empty result; without any words all
targets are 0.  The offsets depend on the seed and the source alone, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
CAP = 2
SEED = "mix-1"


def _ranked(df: DataFrame, order: list, within: list[str], scratch: Scratch, name: str) -> DataFrame:
    """Add ``rank``, the ordinal from 1 in ``order`` within ``within``, without gathering a group in one task.

    ``order`` starts with the columns of ``within``.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pinned = scratch.store(df.repartitionByRange(n, *order).withColumn("pid", F.spark_partition_id()), name)
    keys = [F.col(c) for c in within]
    counts = pinned.groupBy("pid", *within).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*within).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.store(counts.select("pid", *within, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                            f"{name}-offsets")
    here = Window.partitionBy("pid", *keys).orderBy(*order)
    local = pinned.withColumn("rank", F.row_number().over(here).cast("bigint"))
    a, b = local.alias("a"), offsets.alias("b")
    same = F.col("a.pid") == F.col("b.pid")
    for c in within:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, same).select(*[F.col(f"a.{c}") for c in df.columns],
                                  (F.col("a.rank") + F.col("b.before")).alias("rank"))


def source_targets(sizes: DataFrame, weights: Sequence[int], share: Fraction, cap: int, scratch: Scratch) -> DataFrame:
    """(source, source_size, target) for rows (source, size).

    Sources weigh ``weights`` in turn, in code point order.  ``share`` of all words is dealt by
    weight; a target stops at ``cap`` times its source, and what is over is dealt again among
    the others until none is above.  A round is one aggregate over the source table; the
    driver sees two sums.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordinals = _ranked(totals.withColumn("one", F.lit(1)), [F.col("one"), F.col("source").asc_nulls_last()], ["one"],
                       scratch, "sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("bigint")
    table = scratch.store(ordinals.select("source", "source_size", weight.alias("weight")), "weights")
    # The level x/y per weight is kept as exact whole numbers: a source is full where weight * x > cap * size * y.
    whole = table.agg(F.sum("source_size")).first()[0] or 0
    x = y = None
    full = F.lit(False)
    while True:
        row = table.agg(F.sum(F.when(full, F.col("source_size")).otherwise(0)),
                        F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        left, open_weight = share * whole - cap * (row[0] or 0), row[1] or 0
        if open_weight == 0 or (x, y) == (level := (left.numerator, left.denominator * open_weight)):
            break
        x, y = level
        full = (F.col("weight").cast("decimal(38,0)") * F.lit(x).cast("decimal(38,0)")
                > F.col("source_size").cast("decimal(38,0)") * F.lit(cap * y).cast("decimal(38,0)"))
    target = F.when(full, F.col("source_size").cast("double") * cap)
    if open_weight:
        target = target.otherwise((F.col("weight") * F.lit(x)).cast("double") / F.lit(float(y)))
    else:
        target = F.col("source_size").cast("double") * cap
    return table.select("source", "source_size", target.alias("target"))


def systematic_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: Fraction = SHARE, cap: int = CAP,
                   seed: str = SEED) -> DataFrame:
    """Copies that each document of (doc_id, text, source) gives to the mix.

    Returns doc_id, source, size, source_size, target, copies, taken (= copies * size).
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = scratch.store(docs.select(
        "doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint").alias("size")), "sizes")
    targets = scratch.store(source_targets(sizes, weights, share, cap, scratch), "targets")
    ranked = _ranked(sizes, [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id").asc_nulls_last()],
                     ["source"], scratch, "documents")
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("|s"), "source"), F.lit("|n")))), 1, 13)
    offset = F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 52))
    per_source = targets.withColumn("offset", offset).withColumn(
        "expected", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    a, b = ranked.alias("a"), per_source.alias("b")
    crossed = F.floor(F.col("rank") * F.col("expected") + F.col("offset")) \
        - F.floor((F.col("rank") - 1) * F.col("expected") + F.col("offset"))
    return (a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")))
            .select("a.doc_id", "a.source", "size", "source_size", "target",
                    F.least(crossed, F.lit(cap)).cast("bigint").alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def emit_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: every row once per copy, with its ``copy`` number.

    All columns of ``docs`` are kept, but for one named copy, which is replaced.  Rows that agree in doc_id, source and size are numbered by
    text, so each gets the copies of one of them.
    """
    names = [c for c in docs.columns if c != "copy"]
    mixed = systematic_mix(docs.select("doc_id", "text", "source"), **options)
    same = ["mix_id", "mix_source", "mix_size"]
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    key = [F.struct("doc_id").alias("mix_id"), F.struct("source").alias("mix_source")]
    left = docs.select(F.struct(*[F.col(c) for c in names]).alias("row"), *key, size.alias("mix_size"))
    left = left.withColumn("mix_n", F.row_number().over(Window.partitionBy(*same).orderBy("row.text")))
    right = mixed.where("copies > 0").select(*key, F.col("size").alias("mix_size"), "copies")
    right = right.withColumn("mix_n", F.row_number().over(Window.partitionBy(*same).orderBy(F.desc("copies"))))
    return (left.join(right, [*same, "mix_n"])
            .select("row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")))
