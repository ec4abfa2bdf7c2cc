"""Decimal arithmetic for rates, means, durations and changes.

Everything is exact until the one published rounding (half away from zero, two
digits): quotients carry at least eleven digits, and no value passes through a
binary floating-point number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dispatchlens.schemas import DAYS, MEASURE

_MICROS_PER_DAY = 86_400_000_000


def rounded(value: Column) -> Column:
    return F.round(value, 2).cast(MEASURE)


def per_count(total: Column, count: Column) -> Column:
    """``total / count``, null for an empty group."""
    return total / F.nullif(count.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def percent(part: Column, whole: Column) -> Column:
    """Unrounded percentage of two counts, null when ``whole`` is zero."""
    return per_count((part * 100).cast("decimal(20,0)"), whole)


def mean(value: Column, where: Column | None = None) -> Column:
    """Mean of a decimal column as sum over count.

    ``avg`` of a decimal keeps only four more digits than its input; a quotient
    of the sums keeps twenty, so rounding afterwards cannot round twice.
    """
    kept = value if where is None else F.when(where, value)
    return per_count(F.sum(kept), F.count(kept))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def days_between(later: Column, earlier: Column) -> Column:
    """Elapsed days with six digits, counted in whole microseconds."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return (micros.cast("decimal(20,0)") / F.lit(_MICROS_PER_DAY)).cast(DAYS)


def month_of(timestamp: Column) -> Column:
    return F.trunc(timestamp, "MM")


def never_null(condition: Column) -> Column:
    """A flag: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def _count(value: Column) -> Column:
    # Twelve digits keep the product of two counts and its quotient inside a
    # 38-digit decimal; more orders than that raise an overflow error.
    return value.cast("decimal(12,0)")


def expected_late(current_eligible: Column, previous_late: Column, previous_eligible: Column) -> Column:
    """Late orders of the current period at the previous period's late rate."""
    base = F.nullif(_count(previous_eligible), _count(F.lit(0)))
    return _count(current_eligible) * _count(previous_late) / base


def excess_late(
    current_late: Column, current_eligible: Column, previous_late: Column, previous_eligible: Column
) -> Column:
    """Late orders beyond the expectation; one division, so one rounding."""
    base = F.nullif(_count(previous_eligible), _count(F.lit(0)))
    surplus = _count(current_late) * base - _count(current_eligible) * _count(previous_late)
    return surplus / base
