"""Key, reference, domain and cardinality checks (C-1..C-5).

The reference declares keys and constraints on a database; on immutable
Parquet tables the same facts are verified by batch checks that return the
offending rows (empty = the constraint holds).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.operators.relational import for_skew_join


def check_unique(df: DataFrame, keys: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Key values held by more than one row (C-1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def check_reference(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None) -> DataFrame:
    """Rows whose non-NULL ``key`` is missing from ``ref`` (C-2, a foreign key)."""
    ref_key = ref_key or key
    # distinct first: partial aggregation collapses repeated reference keys before the shuffle
    keys = ref.select(F.col(ref_key).alias("_fb_ref")).filter(F.col("_fb_ref").isNotNull()).distinct()
    present = df.filter(F.col(key).isNotNull())
    return present.join(for_skew_join(keys, "_fb_ref"), F.col(key) == F.col("_fb_ref"), "left_anti")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``cols`` (C-3)."""
    return df.filter(has_null(cols))


def check_length(df: DataFrame, bounds: dict[str, int]) -> DataFrame:
    """Rows with a value longer than its ``VARCHAR(n)`` bound, in characters (C-3)."""
    return df.filter(too_long(bounds))


def check_domain(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Rows whose non-NULL value is outside the allowed list (C-4, CHECK IN)."""
    return df.filter(outside(col, values))


def has_null(cols: Sequence[str]) -> Column:
    """Whether any of ``cols`` is NULL."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def too_long(bounds: dict[str, int]) -> Column:
    """Whether any value is longer than its bound; a NULL value never is."""
    cond = F.lit(False)
    for c, n in bounds.items():
        cond = cond | F.coalesce(F.char_length(F.col(c)) > n, F.lit(False))
    return cond


def outside(col: str, values: Sequence[str]) -> Column:
    """Whether a non-NULL value is outside the allowed list."""
    return F.col(col).isNotNull() & ~F.col(col).isin(*values)


def violations(df: DataFrame, rules: dict[str, Column], out: str = "violation") -> DataFrame:
    """Every row once per rule it breaks, with the rule's name in ``out``; all rules in one pass (C-3, C-4)."""
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return df.withColumn(out, F.explode(broken))


def profile_relationship(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Rows, distinct keys and keys met more than once, on both sides; matched rows (C-5).

    One aggregate per side (partial aggregation first) plus one on the join of
    the per-key counts, which are at most one row per key.
    """
    right_key = right_key or left_key
    lk = left.groupBy(F.col(left_key).alias("k")).agg(F.count(F.lit(1)).alias("ln"))
    rk = right.groupBy(F.col(right_key).alias("k")).agg(F.count(F.lit(1)).alias("rn"))
    both = lk.join(rk, "k", "full")
    return both.agg(
        F.sum("ln").cast("bigint").alias("left_rows"),
        F.count(F.when(F.col("ln").isNotNull() & F.col("k").isNotNull(), 1)).alias("left_keys"),
        F.count(F.when(F.col("ln") > 1, 1)).alias("left_repeated_keys"),
        F.sum("rn").cast("bigint").alias("right_rows"),
        F.count(F.when(F.col("rn").isNotNull() & F.col("k").isNotNull(), 1)).alias("right_keys"),
        F.count(F.when(F.col("rn") > 1, 1)).alias("right_repeated_keys"),
        F.sum(F.when(F.col("k").isNotNull(), F.col("ln") * F.col("rn"))).cast("bigint").alias("joined_rows"),
    )
