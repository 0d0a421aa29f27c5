"""Column expressions whose results must not depend on the engine or on row order.

Sums of doubles change with the order in which partitions arrive, and engines
round halves of doubles differently. Money is therefore summed as a decimal and
every rounded figure goes through a six-digit decimal first.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 2)
_WIDE = DecimalType(38, 6)
_MICROS_PER_DAY = 86_400_000_000.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return _col(c).cast(MONEY)


def r2(c: Column | str) -> Column:
    """Round half up to two decimals, as a double."""
    return F.round(_col(c).cast(_WIDE), 2).cast("double")


def exact_mean(total: Column | str, n: Column | str) -> Column:
    """Mean from an exact sum and a count; null when nothing was counted."""
    return F.try_divide(_col(total).cast("double"), _col(n).cast("double"))


def micros_between(later: Column | str, earlier: Column | str) -> Column:
    """Elapsed microseconds as a whole number.

    Timestamps without a zone are subtracted as they stand. Functions that count units
    between them would go through the session zone and its clock changes.
    """
    seconds = (_col(later) - _col(earlier)).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("bigint")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Elapsed days with their fraction."""
    return micros_between(later, earlier) / F.lit(_MICROS_PER_DAY)


def mean_days(later: Column | str, earlier: Column | str) -> Column:
    """Mean of the elapsed days: microseconds are added exactly and divided once."""
    micros = micros_between(later, earlier)
    return exact_mean(F.sum(micros.cast("decimal(20,0)")), F.count(micros)) / F.lit(_MICROS_PER_DAY)


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Elapsed days rounded down, so one hour early is -1 and not 0."""
    return F.floor(days_between(later, earlier))


def month_start(ts: Column | str) -> Column:
    """Midnight on the first of the month, free of the session time zone."""
    return F.trunc(_col(ts).cast("date"), "month").cast("timestamp_ntz")
