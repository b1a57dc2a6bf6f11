"""Exact duplicates by content sort.

Texts are normalised (every run of ``\\x20 \\x09-\\x0D`` becomes one space) and range-partitioned
by sampled splitters, sorted within each range by Spark's external sort, and compared with
their neighbour in full.  A splitter holds a short head of the text, a 64-bit mark of all of it and
the id, so that the sample stays small however long the texts are, texts that share a long
passage still part, and a group that holds a third of all rows is cut over many ranges.  The
sort goes on to the whole text: rows of equal text are neighbours even where two texts share
head and mark, and only the full comparison decides.

Each range numbers its runs of equal texts.  A run that crosses a range is put together from the
first and last text of the ranges: two rows per range, joined with their neighbours on Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch

BLANKS = r"[\x20\x09-\x0D]+"
HEAD = 16  # code points of a text in a splitter

_ROWS = ("doc_id bigint, text_sha256 string, part int, run bigint, opens boolean, "
         "is_first boolean, is_last boolean, edge string")
_ARROW = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("part", pa.int32()), ("run", pa.int64()),
                    ("opens", pa.bool_()), ("is_first", pa.bool_()), ("is_last", pa.bool_()), ("edge", pa.string())])


def normalised(text) -> F.Column:
    """Text with each run of blanks as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal texts of one sorted range.

    In: doc_id, text, text_sha256, part.  The last row of a batch waits for the next one, because
    only the end of the range shows that it is the last; its text is the one text held.
    """
    waiting, run, first = None, -1, True
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(1)
        opens = [True] if waiting is None else [text[0].as_py() != waiting[1]]
        if batch.num_rows > 1:
            opens += pc.not_equal(text.slice(1), text.slice(0, batch.num_rows - 1)).to_pylist()
        runs = []
        for new in opens:
            run += new
            runs.append(run)
        if waiting is not None:
            yield _edge_row(waiting, False)
        last = batch.num_rows - 1
        if last:
            edges = [None] * last
            if first:
                edges[0] = text[0].as_py()
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(0, last), batch.column(2).slice(0, last), batch.column(3).slice(0, last),
                pa.array(runs[:last], pa.int64()), pa.array(opens[:last], pa.bool_()),
                pa.array([first] + [False] * (last - 1), pa.bool_()), pa.array([False] * last, pa.bool_()),
                pa.array(edges, pa.string())], schema=_ARROW)
            first = False
        waiting = (batch.column(0)[last].as_py(), text[last].as_py(), batch.column(2)[last].as_py(),
                   batch.column(3)[last].as_py(), runs[last], opens[last], first)
        first = False
    if waiting is not None:
        yield _edge_row(waiting, True)


def _edge_row(row: tuple, is_last: bool) -> pa.RecordBatch:
    doc_id, text, digest, part, run, opens, is_first = row
    values = [doc_id, digest, part, run, opens, is_first, is_last, text if is_first or is_last else None]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _ARROW, strict=True)], schema=_ARROW)


def _joined_runs(rows: DataFrame) -> DataFrame:
    """(part, run, whole_keep, whole_size, whole_opens) of the runs that cross a range.

    Works on two rows per range: the number of ranges bounds both windows without a key,
    which hold numbers only; the texts are compared in a join.
    """
    ends = rows.where("is_last").select("part", F.col("run").alias("last_run"))
    order = ends.withColumn("seq", F.row_number().over(Window.orderBy("part")))
    left = order.join(rows.where("is_last").select("part", F.col("edge").alias("before")), "part") \
        .select((F.col("seq") + 1).alias("seq"), "before")
    right = order.join(rows.where("is_first").select("part", F.col("edge").alias("after")), "part").select("seq", "after")
    same = left.join(right, "seq").select("seq", (F.col("before") == F.col("after")).alias("linked"))
    spots = order.join(same, "seq", "left").select(
        "part", "seq", F.explode(F.expr("if(last_run > 0, array(0L, last_run), array(0L))")).alias("run"),
        F.coalesce("linked", F.lit(False)).alias("linked"))
    breaks = F.when((F.col("run") == 0) & F.col("linked"), 0).otherwise(1)
    spots = spots.withColumn("chain", F.sum(breaks).over(Window.orderBy("seq", "run")))
    counted = (rows.join(F.broadcast(spots), ["part", "run"])  # at most two rows per range
               .groupBy("part", "run", "chain").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least")))
    chain = Window.partitionBy("chain")
    return (counted.select("part", "run", F.count(F.lit(1)).over(chain).alias("spots"),
                           F.min("least").over(chain).alias("whole_keep"), F.sum("n").over(chain).alias("whole_size"),
                           (F.row_number().over(chain.orderBy("part", "run")) == 1).alias("whole_opens"))
            .where("spots > 1").drop("spots"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Group of equal texts of every row of ``docs`` (doc_id bigint, text string; more columns are not read).

    Returns doc_id, keep_id (smallest doc_id of the group), group_size, kept, text_sha256.  A null
    text is the empty text.  Null ids come after all others: keep_id is null only where the whole
    group has none.  Of rows that repeat id and text one is kept.  An empty table gives no
    rows.  Texts of any length are compared in full.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    keyed = (docs.select("doc_id", normalised(F.col("text")).alias("text"))
             .select("doc_id", "text", F.substring("text", 1, HEAD).alias("head"), F.xxhash64("text").alias("mark")))
    by_id = F.col("doc_id").asc_nulls_last()
    ranged = (keyed.repartitionByRange("head", "mark", by_id)
              .sortWithinPartitions("head", "mark", "text", by_id)
              .select("doc_id", "text", F.sha2("text", 256).alias("text_sha256"), F.spark_partition_id().alias("part")))
    rows = scratch.store(ranged.mapInArrow(_runs, _ROWS), "runs")
    across = scratch.store(_joined_runs(rows), "across")
    run = Window.partitionBy("part", "run")  # a run lies within one range
    grouped = rows.select("doc_id", "text_sha256", "part", "run", "opens",
                          F.min("doc_id").over(run).alias("keep_id"), F.count(F.lit(1)).over(run).alias("group_size"))
    crosses = F.col("whole_size").isNotNull()
    return (grouped.join(F.broadcast(across), ["part", "run"], "left")  # at most two rows per range
            .select("doc_id",
                    F.when(crosses, F.col("whole_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.when(crosses, F.col("whole_size")).otherwise(F.col("group_size")).alias("group_size"),
                    (F.col("opens") & F.coalesce("whole_opens", F.lit(True))).alias("kept"), "text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, whose id is the smallest of its group of equal texts.

    Of rows that repeat id and text one stays; rows without an id are kept only where no row of the
    group has one (then one of them).
    """
    names = docs.columns
    kept = exact_duplicates(docs.select("doc_id", "text")).where("kept").select(
        F.struct("doc_id", "text_sha256").alias("kept_row"))
    row = F.struct(F.col("doc_id"), F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
    held = docs.select(F.struct(*names).alias("row"), row.alias("kept_row")).join(kept, "kept_row", "left_semi")
    first = Window.partitionBy("kept_row").orderBy("row.text")
    return held.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*")
