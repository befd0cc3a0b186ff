"""Numeric and date rules shared by the whole library.

Money is aggregated exactly as unscaled BIGINT (cents, or 1e-4 units for
item subtotals) and reported as DOUBLE: dividing the exact integer sum by
10^scale gives the same double as casting the DECIMAL sum. Averages are
``sum / count`` in DOUBLE. ``ROUND`` is half away from zero.
Divisions are guarded with ``nullif`` so ANSI mode never raises on zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, n: int = 2) -> Column:
    """ROUND(c, n) half away from zero on a DOUBLE."""
    c = col(c).cast("double")
    s = float(10 ** n)
    return (F.when(c < 0, -F.floor(-c * s + 0.5) / s)
            .otherwise(F.floor(c * s + 0.5) / s))


def dollars(c, scale: int = 2) -> Column:
    """An exact unscaled money value (or sum) as DOUBLE."""
    return col(c) / float(10 ** scale)


def money(c, scale: int = 2) -> Column:
    """SUM of an unscaled money column, reported as DOUBLE."""
    return dollars(F.sum(col(c)), scale)


def mean(c, scale: int = 2) -> Column:
    """AVG of an unscaled money column as DOUBLE: exact sum / count."""
    return dollars(F.sum(col(c)), scale) / F.nullif(F.count(col(c)), F.lit(0))


def ratio(num, den) -> Column:
    """num / NULLIF(den, 0) in DOUBLE."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def pct(num, den) -> Column:
    """num * 100.0 / NULLIF(den, 0) in DOUBLE."""
    return col(num).cast("double") * 100.0 / F.nullif(col(den).cast("double"), F.lit(0.0))


def times(a, b) -> Column:
    """a * b of two integers as DECIMAL(38,0): a fan-out product may pass BIGINT."""
    return col(a).cast("decimal(38,0)") * col(b)


def count_if(cond: Column) -> Column:
    """COUNT(CASE WHEN cond THEN 1 END)."""
    return F.count(F.when(cond, F.lit(1)))


def whole_days(later, earlier) -> Column:
    """EXTRACT(DAY FROM later - earlier) for timestamps: whole days, truncated."""
    return F.extract(F.lit("DAY"), col(later) - col(earlier)).cast("bigint")


def month_of(ts) -> Column:
    """DATE_TRUNC('month', ts) as a DATE (zone independent)."""
    return F.trunc(F.to_date(col(ts)), "month")


def week_of(ts) -> Column:
    """DATE_TRUNC('week', ts) as a DATE: the ISO Monday."""
    return F.trunc(F.to_date(col(ts)), "week")


def not_cancelled(status="order_status") -> Column:
    """``order_status != 'Cancelled'`` (NULL status is dropped, as in SQL)."""
    return col(status) != F.lit("Cancelled")
