"""Relational building blocks of the survey analyses.

Each helper is a short composition of DataFrame operators.  Shapes that
Spark would otherwise plan badly at scale are written the scalable way:

* group totals next to detail rows use an aggregate joined back, not a
  window (a window sends a whole group to one task);
* percentages of a grand total use an uncorrelated scalar subquery
  (``DataFrame.scalar``) over the grouped rows, evaluated once;
* the keyed side of a join is moved off its aggregate's partitioning
  (:func:`for_skew_join`), so that adaptive execution can split a hot key;
* pivots are one aggregate of conditional expressions: one shuffle, partial
  aggregation on the map side;
* top-k is ``orderBy().limit()`` which plans as a per-partition top-k
  merged on the driver (``TakeOrderedAndProject``), never a full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.exprs import round_int


def for_skew_join(keyed: DataFrame, *cols: str) -> DataFrame:
    """``keyed`` (one row per key) dealt by another hash than the join's.

    Adaptive execution splits a hot key only where both sides of a join end in
    the join's own exchange.  An aggregate by the join key needs none, so its
    rows are dealt otherwise first; that moves one row per key.
    """
    return keyed.repartition(F.xxhash64(*cols))


def distinct_values(df: DataFrame, *cols: str | Column) -> DataFrame:
    """``SELECT DISTINCT cols`` (F-15, F-16)."""
    return df.select(*cols).distinct()


def count_by(df: DataFrame, keys: Sequence[str | Column], counted: str | None = None,
             out: str = "n") -> DataFrame:
    """``COUNT(col)`` (NULLs skipped) or ``COUNT(*)`` per group (A-2, A-7, A-8)."""
    measure = F.count(F.col(counted)) if counted else F.count(F.lit(1))
    return df.groupBy(*keys).agg(measure.alias(out))


def share_of_total(df: DataFrame, keys: Sequence[str], measure: str | None, how: str,
                   out_value: str, out_pct: str) -> DataFrame:
    """Per-group count or sum, and its share of the grand total in percent, rounded (A-12).

    ``how`` is ``"count"`` (``COUNT(measure)`` or ``COUNT(*)`` when measure is
    None) or ``"sum"``.  The grand total adds up the groups, so the input is
    scanned once; a zero total yields NULL.
    """
    if how == "count":
        agg = F.count(F.col(measure)) if measure else F.count(F.lit(1))
    elif how == "sum":
        agg = F.sum(F.col(measure))
    else:
        raise ValueError(how)
    grouped = df.groupBy(*keys).agg(agg.alias(out_value))
    total = grouped.agg(F.sum(out_value)).scalar()
    share = F.try_divide(F.col(out_value).cast("double"), total.cast("double")) * F.lit(100.0)
    return grouped.withColumn(out_pct, round_int(share))


def join_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner",
                equal: dict[str, str] | None = None) -> DataFrame:
    """Rows of ``df`` with the row of ``groups`` (one per key) of their group; NULL keys are a group too.

    The keys of ``groups`` are compared null-safe, which Spark plans as an equi-join on the key made
    non-null and a flag: still a shuffled join that adaptive execution can split, so a third of all rows may
    share one key, or share NULL.  ``equal`` adds plain equalities (column of df: column of groups).
    """
    names = {k: f"_fb_group{i}" for i, k in enumerate(keys)}
    other = groups.withColumnsRenamed(names)
    cond = F.lit(True)
    for k, name in names.items():
        cond = cond & F.col(k).eqNullSafe(F.col(name))
    for left, right in (equal or {}).items():
        cond = cond & (F.col(left) == F.col(right))
    joined = df.join(for_skew_join(other, *names.values()), cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*names.values())


def with_group_total(df: DataFrame, keys: Sequence[str], measure: str, out: str) -> DataFrame:
    """Detail rows next to the sum of ``measure`` over their group, joined by ``=`` (J-8): NULL keys drop out.

    Partial aggregation shrinks the totals before the shuffle; the join back
    lets adaptive execution broadcast small totals or split a skewed key.  ``df`` is
    read twice, for the rows and for the totals: pass a stored frame (``snapshot``) where it
    is the result of joins.
    """
    totals = df.groupBy(*keys).agg(F.sum(measure).alias(out))
    return df.join(for_skew_join(totals, *keys), list(keys), "inner")


def with_group_max(df: DataFrame, keys: Sequence[str], measure: str, out: str) -> DataFrame:
    """``MAX(measure) OVER (PARTITION BY keys)`` as an aggregate joined back (W-6).

    As the window has it, rows whose key is NULL form one group, and a group without a value has the maximum NULL.
    """
    maxima = df.groupBy(*keys).agg(F.max(measure).alias(out))
    return join_groups(df, maxima, keys)


def _distinct_keys(other: DataFrame, key: str) -> DataFrame:
    """The key column of ``other`` without repeats.

    The distinct is a hash aggregate with a map-side partial step, so a key
    held by a third of ``other`` shrinks to one row per map task before the
    shuffle, instead of landing whole in the join task of that key.
    """
    return other.select(F.col(key).alias("_fb_key")).distinct()


def semi(df: DataFrame, other: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """``WHERE key IN (SELECT key FROM other)`` as a left semi-join (J-9)."""
    keys = for_skew_join(_distinct_keys(other, right_key or left_key), "_fb_key")
    return df.join(keys, F.col(left_key) == F.col("_fb_key"), "left_semi")


def not_in(df: DataFrame, other: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """``WHERE key NOT IN (SELECT key FROM other)`` with SQL's NULL rules (J-10).

    A plain anti-join differs when NULLs appear: one NULL in ``other`` makes
    the predicate unknown for every row, and a NULL ``key`` is unknown unless
    ``other`` is empty.  Both facts come from one scalar aggregate over the
    distinct keys (run once), and the anti-join itself stays a shuffled or
    broadcast join chosen by size, so the key list need not fit a broadcast.
    """
    keys = _distinct_keys(other, right_key or left_key)
    # two scalar aggregates over the same keys: Spark merges them into one subquery, run once
    n_keys = keys.agg(F.count(F.lit(1))).scalar()
    n_null = keys.agg(F.count_if(F.col("_fb_key").isNull())).scalar()
    anti = df.join(for_skew_join(keys, "_fb_key"), F.col(left_key) == F.col("_fb_key"), "left_anti")
    return anti.filter((n_keys == 0) | (F.col(left_key).isNotNull() & (n_null == 0)))


def lookup_by(df: DataFrame, key: str, single_key_rows: DataFrame) -> DataFrame:
    """``WHERE key = (SELECT ...)``: the subquery must return at most one row (J-11).

    Spark raises an error for more than one row, as MySQL does; zero rows give NULL.
    """
    return df.filter(F.col(key) == single_key_rows.scalar())


def above_average(df: DataFrame, measure: str) -> DataFrame:
    """Rows whose ``measure`` exceeds the average over all rows (J-13, F-23)."""
    return df.filter(F.col(measure) > df.agg(F.avg(measure)).scalar())


def top_k(df: DataFrame, key: str, k: int, out: str = "n", counted: str | None = None) -> DataFrame:
    """The ``k`` keys with the most rows; ties broken by key (O-4, M-12)."""
    counted = counted or key
    return (df.groupBy(key).agg(F.count(F.col(counted)).alias(out))
              .orderBy(F.col(out).desc(), F.col(key).asc()).limit(k))


def pivot_avg(df: DataFrame, row_key: Column | str, col_expr: Column, values: Sequence[tuple[str, Column]],
              measure: str, row_name: str, round_to_int: bool = True) -> DataFrame:
    """Fixed-column pivot of ``AVG(CASE WHEN col matches v THEN measure END)`` (A-14, A-16).

    ``values`` pairs an output column name with the predicate on ``col_expr``'s
    value.  All columns come from one aggregate: one shuffle, partial
    aggregation before it.
    """
    aggs = []
    for name, pred in values:
        avg = F.avg(F.when(pred, F.col(measure)))
        aggs.append((round_int(avg) if round_to_int else avg).alias(name))
    key = F.col(row_key) if isinstance(row_key, str) else row_key
    return df.groupBy(key.alias(row_name)).agg(*aggs)


def pivot_share(df: DataFrame, keys: Sequence[str], category: str, values: Sequence[str],
                measure: str, null_groups: bool = True) -> DataFrame:
    """Per group, the percent of ``measure`` that falls in each category, rounded (A-15, A-17).

    ``ROUND(SUM(CASE WHEN category = v THEN measure ELSE 0 END) * 100.0 / group_total, 0)``.
    The reference joins the detail with a per-group total; the total is the
    sum over the same group, so one aggregate computes both without the join.

    NULL keys: with ``null_groups`` they are groups, as ``GROUP BY`` has them (A-15).  Without, rows in which
    any key is NULL are left out, as the reference's join of the totals by ``=`` leaves them out (A-17).
    """
    if not null_groups:
        df = df.dropna("any", subset=list(keys))
    total = F.sum(F.col(measure)).cast("double")
    aggs = []
    for v in values:
        part = F.sum(F.when(F.col(category) == v, F.col(measure)).otherwise(F.lit(0))).cast("double")
        aggs.append(round_int(F.try_divide(part * F.lit(100.0), total)).alias(v))
    return df.groupBy(*keys).agg(*aggs)
