"""Window-style analyses (W-1, W-5, W-7) built on the skew-safe ordered helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.ordered import lead_within, rank_within
from fieldbook.operators.relational import join_groups


def rank_groups(df: DataFrame, key: str, measure: str, out_measure: str, out_rank: str) -> DataFrame:
    """``SUM(measure)`` per key and ``RANK() OVER (ORDER BY SUM(measure) DESC)`` (W-1).

    Aggregate first, then rank the aggregated rows; the rank itself is the
    range-partitioned one, so a large number of groups is not sent to one task.
    """
    agg = df.groupBy(key).agg(F.sum(measure).alias(out_measure))
    return rank_within(agg, [], [out_measure], descending=True, tiebreak=[key], rank=out_rank)


def priority_ranks(df: DataFrame, by: str, order: str, tiebreak: str,
                   rank: str, dense_rank: str, row_number: str) -> DataFrame:
    """RANK, DENSE_RANK and ROW_NUMBER per ``by`` ordered by ``order`` descending (W-2..W-4)."""
    return rank_within(df, [by], [order], descending=True, tiebreak=[tiebreak],
                       rank=rank, dense_rank=dense_rank, row_number=row_number)


def lead_gap(df: DataFrame, key: str, measure: str, out_next: str, out_gap: str) -> DataFrame:
    """``measure - LEAD(measure) OVER (ORDER BY measure DESC)`` on already aggregated rows (W-5).

    Ties are ordered by ``key`` so the result is deterministic (M-12).
    """
    led = lead_within(df, [], [measure], measure, out_next, descending=True, tiebreak=[key])
    return led.withColumn(out_gap, F.col(measure) - F.col(out_next))


def latest_per_key(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Rows whose ``ordinal`` equals the maximum of their ``key`` (ties kept) (W-7).

    ``MAX() OVER (PARTITION BY key)`` becomes a partial aggregate and a null-safe semi-join: rows without a key
    are one group, rows without an ordinal never equal a maximum.
    """
    maxima = df.groupBy(key).agg(F.max(ordinal).alias("_fb_max"))
    return join_groups(df, maxima, [key], "left_semi", equal={ordinal: "_fb_max"})
