"""Ordinals, ranks and next-row values within ordered groups, safe under skew.

``Window.partitionBy(g).orderBy(o)`` puts every row of a group into one task;
when one group holds a third of the data (five water-source types, one busy
location) that task becomes the whole job.  The helpers here split the work
by *range* instead:

1. ``repartitionByRange`` on ``(group, order)``: a hot group is spread over
   many partitions, every partition holds a contiguous slice of the order.
2. the partition id is added with a built-in function and the rows are written
   once as Parquet under the shared checkpoint folder.  That pins the ids (a
   re-sampled range partitioner could otherwise move rows) and cuts the lineage.
3. ``Window.partitionBy(partition id, group)`` numbers the rows of a slice: no
   window task holds more than one range partition, and every column, the
   keys included, stays as Spark has it (exact bigint, NaN, decimal, timestamp).
4. per (partition, group) totals are summed over earlier partitions.  Only
   the first group of a partition can continue from an earlier partition, so
   the non-zero offsets number at most one per partition: a size bound that
   makes the broadcast join back safe at any data size.  The offsets are
   stored too, so readers of the result only pay a map-side join.

Ties inside ``order`` are broken by the caller's ``tiebreak`` columns for
row numbers; ranks and dense ranks come from the same pass (tie runs are
numbered locally and stitched across partition boundaries).  Pass a unique
``tiebreak`` (a record id): range partitioning keeps identical sort keys
together, so with a unique last key even one tie holding a third of the rows
is spread over many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.sources.store import current_store

PID = "_fb_pid"
LOCAL = "_fb_local"
SEG = "_fb_seg"
OFF = "_fb_off"
FIRST = "_fb_first"
NEXT = "_fb_next"
RN = "_fb_rn"
RSTART = "_fb_rstart"
DENSE = "_fb_dense"


RANGE_PARTITIONS_CONF = "fieldbook.rangePartitions"


def _n_partitions(df: DataFrame) -> int | None:
    """Explicit range partitions for an ordered pass (``fieldbook.rangePartitions``), or None.

    Size it so one partition is about 128 MB of input; the boundary tables
    have at most this many rows, so even 100 000 partitions broadcast cheaply.
    When unset, the pass uses the shuffle partitions and adaptive execution
    merges small neighbouring range partitions by size.  Merging keeps every
    task on one contiguous slice of the order, and range repartitions are
    never split for skew, so the local pass stays valid either way.
    """
    value = df.sparkSession.conf.get(RANGE_PARTITIONS_CONF, None)
    return int(value) if value else None


def _pin(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` with its partition ids once to the shared folder and read it back (a cut, columnar lineage).

    The copy belongs to the current owner (:mod:`fieldbook.sources.store`), as the boundary tables do.
    """
    return current_store(df.sparkSession).store(df.withColumn(PID, F.spark_partition_id()), name)


def _bounds(df: DataFrame, name: str) -> DataFrame:
    """Store a boundary table (at most one row per range partition), so that readers pay a map-side join only."""
    return current_store(df.sparkSession).store(df.coalesce(1), name)


def _sort_exprs(order: Sequence[str], descending: bool | Sequence[bool]) -> list[Column]:
    if isinstance(descending, bool):
        descending = [descending] * len(order)
    out = []
    for name, is_desc in zip(order, descending):
        # MySQL order: NULL first ascending, last descending (M-6)
        out.append(F.col(name).desc_nulls_last() if is_desc else F.col(name).asc_nulls_first())
    return out


def range_sorted(df: DataFrame, by: Sequence[str], order: Sequence[str],
                 descending: bool | Sequence[bool] = False, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Range-partition on (by, order, tiebreak), a contiguous slice per partition: the shared first stage.

    Range bounds are sampled from the data, so a group holding a third of the
    rows is cut into many contiguous slices instead of one partition.
    """
    sort_cols = [F.col(b).asc_nulls_first() for b in by] + _sort_exprs(list(order), descending) + \
        [F.col(t).asc_nulls_first() for t in tiebreak]
    n = _n_partitions(df)
    return df.repartitionByRange(n, *sort_cols) if n else df.repartitionByRange(*sort_cols)


def _slice(by: Sequence[str], order: Sequence[str], descending: bool | Sequence[bool], tiebreak: Sequence[str] = ()):
    """Window over the rows that one range partition holds of one group."""
    return Window.partitionBy(PID, *by).orderBy(*_sort_exprs(list(order), descending),
                                                *[F.col(t).asc_nulls_first() for t in tiebreak])


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str,
                  descending: bool | Sequence[bool] = False, tiebreak: Sequence[str] = (),
                  weight: str | None = None) -> DataFrame:
    """Inclusive running count (or running sum of ``weight``) within ``by`` along ``order``.

    With ``weight=None`` and a total order this is ``ROW_NUMBER()``.  The
    output keeps every input column and adds ``out``.
    """
    by = list(by)
    staged = range_sorted(df, by, order, descending, tiebreak)

    kind = T.LongType() if weight is None else df.schema[weight].dataType
    local_type: T.DataType = (T.LongType() if isinstance(kind, T.IntegralType)
                              else T.DecimalType(38, kind.scale) if isinstance(kind, T.DecimalType) else T.DoubleType())
    pinned = _pin(staged, "running")
    here = _slice(by, order, descending, tiebreak)
    so_far = (F.row_number().over(here) if weight is None else
              F.sum(F.coalesce(F.col(weight), F.lit(0))).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    local = pinned.withColumn(LOCAL, so_far.cast(local_type))

    # each (partition, group) slice contributes its own total to later slices of the group
    slice_total = F.sum(F.coalesce(F.col(weight), F.lit(0))) if weight else F.count(F.lit(1))
    seg = pinned.groupBy(PID, *by).agg(slice_total.cast(local_type).alias(SEG))
    earlier = (Window.partitionBy(*by) if by else Window).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offs = (seg.select(F.col(PID).alias("_fb_opid"), *[F.col(b).alias(f"_fb_k{i}") for i, b in enumerate(by)],
                       F.sum(SEG).over(earlier).alias(OFF))
            .filter(F.col(OFF) != 0))
    offs = _bounds(offs, "offsets")
    # At most one continuing group per range partition: |offs| <= n, so broadcast is bounded.
    cond = F.col(PID) == F.col("_fb_opid")
    for i, b in enumerate(by):
        cond = cond & F.col(b).eqNullSafe(F.col(f"_fb_k{i}"))
    joined = local.join(F.broadcast(offs), cond, "left")
    total = (F.col(LOCAL) + F.coalesce(F.col(OFF), F.lit(0))).cast(local_type).alias(out)
    return joined.select(*[F.col(c) for c in df.columns], total)


def row_number_within(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str,
                      descending: bool | Sequence[bool] = False, tiebreak: Sequence[str] = ()) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY by ORDER BY order, tiebreak)`` as INT."""
    res = running_total(df, by, order, out, descending, tiebreak)
    return res.withColumn(out, F.col(out).cast("int"))


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[str],
                descending: bool | Sequence[bool] = False, tiebreak: Sequence[str] = (),
                rank: str | None = None, dense_rank: str | None = None,
                row_number: str | None = None) -> DataFrame:
    """``RANK`` / ``DENSE_RANK`` / ``ROW_NUMBER`` over ``PARTITION BY by ORDER BY order`` in one pass.

    One range-partitioned, sorted pass numbers rows, tie runs and distinct
    values inside each partition.  A group split over several partitions is
    then fixed up from a per-(partition, group) summary: row offsets, distinct
    values seen before, and whether the partition's first tie run continues
    the previous partition's last one (its rank then comes from where that run
    began, resolved across any number of partitions).  Only the first group of
    a partition can need a fix-up, so the correction table has at most one
    row per partition and is broadcast with that bound.  ``tiebreak`` orders
    rows inside a tie for ``ROW_NUMBER`` only.  There is one path for every size.
    """
    by, order = list(by), list(order)
    staged = range_sorted(df, by, order, descending, tiebreak)
    ties = _slice(by, order, descending)
    local = _pin(staged, "ranks").withColumns({
        RN: F.row_number().over(_slice(by, order, descending, tiebreak)).cast("long"),
        RSTART: F.rank().over(ties).cast("long"), DENSE: F.dense_rank().over(ties).cast("long")})

    summary = local.groupBy(PID, *by).agg(
        F.max(RN).alias("_fb_cnt"), F.max(DENSE).alias("_fb_runs"),
        F.max_by(F.col(RSTART), F.col(RN)).alias("_fb_last_start"),
        *[F.min_by(F.col(o), F.col(RN)).alias(f"_fb_first{i}") for i, o in enumerate(order)],
        *[F.max_by(F.col(o), F.col(RN)).alias(f"_fb_last{i}") for i, o in enumerate(order)])
    chunks = (Window.partitionBy(*by) if by else Window).orderBy(PID)
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    upto = chunks.rowsBetween(Window.unboundedPreceding, 0)
    cont = F.lag(F.lit(True)).over(chunks).isNotNull()
    for i in range(len(order)):
        cont = cont & F.col(f"_fb_first{i}").eqNullSafe(F.lag(f"_fb_last{i}").over(chunks))
    rn_off = F.coalesce(F.sum("_fb_cnt").over(before), F.lit(0))
    fixed = summary.select(PID, *by, "_fb_cnt", "_fb_runs", "_fb_last_start",
                           rn_off.alias("_fb_rn_off"), cont.alias("_fb_cont"))
    anchor = F.when(~((F.col("_fb_runs") == 1) & F.col("_fb_cont")), F.col("_fb_rn_off") + F.col("_fb_last_start"))
    fixed = fixed.select(
        F.col(PID).alias("_fb_opid"), *[F.col(b).alias(f"_fb_k{i}") for i, b in enumerate(by)],
        "_fb_rn_off", "_fb_cont",
        (F.coalesce(F.sum("_fb_runs").over(before), F.lit(0)) -
         F.sum(F.col("_fb_cont").cast("long")).over(upto)).alias("_fb_dense_off"),
        F.last(anchor, ignorenulls=True).over(before).alias("_fb_cont_rank"))
    # Only a partition's first group can have earlier chunks: at most one row per partition.
    fixed = _bounds(fixed.filter(F.col("_fb_rn_off") > 0), "rank-offsets")

    cond = F.col(PID) == F.col("_fb_opid")
    for i, b in enumerate(by):
        cond = cond & F.col(b).eqNullSafe(F.col(f"_fb_k{i}"))
    joined = local.join(F.broadcast(fixed), cond, "left")
    out_cols = [F.col(c) for c in df.columns]
    if row_number is not None:
        out_cols.append((F.col(RN) + F.coalesce(F.col("_fb_rn_off"), F.lit(0))).cast("int").alias(row_number))
    if rank is not None:
        continued = F.coalesce(F.col("_fb_cont"), F.lit(False)) & (F.col(DENSE) == 1)
        own = F.col(RSTART) + F.coalesce(F.col("_fb_rn_off"), F.lit(0))
        out_cols.append(F.when(continued, F.col("_fb_cont_rank")).otherwise(own).cast("int").alias(rank))
    if dense_rank is not None:
        out_cols.append((F.col(DENSE) + F.coalesce(F.col("_fb_dense_off"), F.lit(0))).cast("int").alias(dense_rank))
    return joined.select(*out_cols)


def lead_within(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str,
                descending: bool | Sequence[bool] = False, tiebreak: Sequence[str] = ()) -> DataFrame:
    """``LEAD(value, 1) OVER (PARTITION BY by ORDER BY order, tiebreak)``; NULL after the last row.

    The last row that a range partition holds of a group takes its next value from the
    first row of the group in a later partition.  Only a partition's last group can go on
    there, so the boundary table has one row per partition at most and is broadcast with
    that bound.
    """
    by = list(by)
    here = _slice(by, order, descending, tiebreak)
    local = _pin(range_sorted(df, by, order, descending, tiebreak), "lead").withColumns({
        FIRST: F.row_number().over(here) == 1, RN: F.lead(F.lit(True)).over(here), NEXT: F.lead(F.col(value)).over(here)})
    keys = [F.col(b).alias(f"_fb_k{i}") for i, b in enumerate(by)]
    after = (Window.partitionBy(*by) if by else Window).orderBy(PID)  # one row per (partition, group)
    bounds = (local.filter(F.col(FIRST)).select(
        F.col(PID).alias("_fb_p"), *keys, F.lead(F.lit(True)).over(after).alias("_fb_more"), F.lead(F.col(value)).over(after).alias("_fb_v"))
        .filter("_fb_more"))
    bounds = _bounds(bounds, "next-values")
    cond = F.col(RN).isNull() & (F.col(PID) == F.col("_fb_p"))
    for i, b in enumerate(by):
        cond = cond & F.col(b).eqNullSafe(F.col(f"_fb_k{i}"))
    joined = local.join(F.broadcast(bounds), cond, "left")
    result = F.when(F.col(RN).isNull(), F.col("_fb_v")).otherwise(F.col(NEXT)).alias(out)
    return joined.select(*[F.col(c) for c in df.columns], result)
