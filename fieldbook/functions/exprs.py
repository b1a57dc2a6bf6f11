"""Column-expression helpers for the MySQL semantics the survey queries rely on.

All helpers return plain ``Column`` expressions built from
``pyspark.sql.functions``, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: the digits that a division adds to those of its dividend (M-3).
DIV_DIGITS = 4


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def like_ci(c: ColumnOrName, pattern: str) -> Column:
    """``LIKE`` under a case-insensitive collation (M-1): ``%`` and ``_`` wildcards, any case."""
    return col(c).ilike(pattern)


def not_like_ci(c: ColumnOrName, pattern: str) -> Column:
    return ~like_ci(c, pattern)


def eq_ci(c: ColumnOrName, value: str) -> Column:
    """``=`` under a case-insensitive collation (M-2), through Spark's ``UTF8_LCASE`` collation.

    The survey's literals are written in the data's case, so the jobs use
    plain equality; this is for callers whose inputs are not.
    """
    return F.collate(col(c), "UTF8_LCASE") == F.lit(value)


def exact_div(num: ColumnOrName, den: ColumnOrName, num_scale: int = 0, den_scale: int = 0) -> Column:
    """``num / den`` of exact numbers as MySQL types it (M-3): a decimal with four digits more than ``num`` has.

    The quotient is taken in whole numbers with its remainder, so it is rounded once, half away from
    zero; a zero divisor gives NULL (M-5).  ``num`` may have up to 18 digits in all.
    """
    scale = num_scale + DIV_DIGITS
    n = (col(num).cast(f"decimal({18 + num_scale},{num_scale})") * F.lit(10 ** (scale + den_scale)).cast("decimal(19,0)")).cast("decimal(38,0)")
    d = (col(den).cast(f"decimal({18 + den_scale},{den_scale})") * F.lit(10 ** den_scale).cast("decimal(10,0)")).cast("decimal(28,0)")
    d = F.nullif(d, F.lit(0).cast("decimal(28,0)"))
    rest = F.try_mod(n, d)
    whole = F.try_divide(n - rest, d).cast("decimal(38,0)")
    # 2 * rest >= den, without leaving the digits that rest has
    up = F.when(F.abs(rest) >= F.abs(d) - F.abs(rest), F.signum(n).cast("int") * F.signum(d).cast("int")).otherwise(0)
    return ((whole + up.cast("decimal(1,0)")).cast("decimal(32,0)") / F.lit(10 ** scale).cast("decimal(19,0)")).cast(f"decimal(38,{scale})")


def exact_avg(c: ColumnOrName) -> Column:
    """``AVG`` of an integer column as MySQL types it (M-3): an exact decimal with four digits."""
    return exact_div(F.sum(col(c)), F.count(col(c)))


def avg_nonzero(c: ColumnOrName) -> Column:
    """``AVG(NULLIF(x, 0))``: zeros count as missing (A-13)."""
    return F.avg(F.nullif(col(c), F.lit(0)))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields NULL on a zero divisor, as MySQL does in SELECT (M-5)."""
    return F.try_divide(col(num), col(den))


def safe_pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den * 100`` as a double, NULL when ``den`` is zero."""
    return safe_div(col(num).cast("double"), col(den).cast("double")) * F.lit(100.0)


def round_int(c: ColumnOrName, scale: int = 0) -> Column:
    """``ROUND`` half away from zero (M-4), returned as INT for integer outputs."""
    return F.round(col(c), scale).cast("int")


def round_long(c: ColumnOrName, scale: int = 0) -> Column:
    return F.round(col(c), scale).cast("bigint")


def weekday_name(ts: ColumnOrName) -> Column:
    """``DAYNAME``: the full English weekday name, e.g. ``Sunday`` (X-15)."""
    return F.date_format(col(ts), "EEEE")


def hour_label(ts: ColumnOrName) -> Column:
    """``TIME_FORMAT(TIME(ts), '%H:00')``, e.g. ``05:00`` (X-17, X-18)."""
    return F.date_format(col(ts), "HH:00")


def hour_of_day(ts: ColumnOrName) -> Column:
    """``HOUR(ts)`` as INT (X-16)."""
    return F.hour(col(ts)).cast("int")


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """``DATEDIFF(end, start)``: whole calendar days, time of day ignored (X-14)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def concat_str(*parts: ColumnOrName | int | str) -> Column:
    """``CONCAT`` with MySQL's implicit number-to-string cast; NULL in gives NULL out (X-4, M-8)."""
    cols = []
    for p in parts:
        if isinstance(p, Column):
            cols.append(p.cast("string"))
        else:
            cols.append(F.lit(str(p)))
    return F.concat(*cols)


def byte_length(c: ColumnOrName) -> Column:
    """``LENGTH``: bytes, as MySQL counts them (X-5, M-7)."""
    return F.octet_length(col(c))


def if_(cond: Column, a, b) -> Column:
    """``IF(cond, a, b)`` (X-11)."""
    return F.when(cond, a).otherwise(b)
