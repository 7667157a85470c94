"""Scalar helpers shared by every report.

The reports compute money and ratios the way PostgreSQL's ``numeric`` does:
exact decimal arithmetic, rounding half away from zero. Spark gets there by
keeping money in ``DecimalType`` all the way through aggregation and by
quantising to ten decimals before the final ``round`` (never ``round`` on a
double: ``round(0.285D, 2)`` is not portable). Results leave as ``double``
(money, rates), ``bigint`` (counts, ranks) and ``date`` (months).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quantisation applied before every final ROUND (10 decimals, 20 integer digits).
QUANTUM = "decimal(30,10)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int) -> Column:
    """``ROUND(x::numeric, digits)`` as a double, half away from zero."""
    return F.round(col(c).cast(QUANTUM), digits).cast("double")


def nullif_zero(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(0))


def pct(num: Column | str, den: Column | str) -> Column:
    """``100.0 * num / NULLIF(den, 0)`` in exact decimal arithmetic (unrounded)."""
    return F.lit(Decimal("100.0")) * col(num) / nullif_zero(den)


def pct_rounded(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    return round_half_up(pct(num, den), digits)


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / NULLIF(den, 0)`` with a decimal numerator (exact)."""
    return col(num).cast("decimal(38,10)") / nullif_zero(den)


def exact_mean(total: Column | str, count: Column | str) -> Column:
    """Mean from a decimal sum and a count, kept exact to >= 10 decimals."""
    return col(total).cast("decimal(28,4)") / nullif_zero(col(count).cast("decimal(20,0)"))


def double_pct_key(num: Column | str, den: Column | str) -> Column:
    """Rank key for a percentage: ``100.0 * num / den`` in doubles.

    Ranking on a ratio must break ties identically everywhere; computing the
    key from two doubles (and NULL for a zero divisor) gives a value every
    engine reproduces bit for bit."""
    return F.lit(100.0) * col(num).cast("double") / nullif_zero(col(den).cast("double"))


def month_start(ts: Column | str) -> Column:
    """``DATE_TRUNC('month', ts)::date`` without going through a time zone."""
    return F.trunc(F.to_date(col(ts)), "month")


def month_index(later_month: Column | str, earlier_month: Column | str) -> Column:
    """Whole months between two month starts (``EXTRACT`` of ``AGE``)."""
    a, b = col(later_month), col(earlier_month)
    return (F.year(a) - F.year(b)) * 12 + (F.month(a) - F.month(b))


def ts_literal(value: str) -> Column:
    """A wall-clock timestamp literal, independent of the session zone."""
    return F.lit(value).cast("timestamp_ntz")

