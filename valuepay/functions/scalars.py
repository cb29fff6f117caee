"""Scalar functions (F1-F9) as built-in Column expressions (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from valuepay.schemas import SEGMENT_HIGH, SEGMENT_MID, SEGMENT_STANDARD, SEGMENT_WHALE

# Exact decimal used to round computed doubles; wide enough for any money total.
ROUND_DECIMAL = "decimal(38,6)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_money(x, digits: int = 2) -> Column:
    """Round half away from zero, returned as double.

    Decimals round exactly; doubles pass through decimal(38,6) first, so that
    1.005 rounds to 1.01 as written (plain double rounding is engine dependent).
    """
    x = _c(x)
    return F.round(x.cast(ROUND_DECIMAL), digits).cast("double")


def order_date(ts) -> Column:
    """toDate: calendar date of a timestamp (NULL stays NULL)."""
    return F.to_date(_c(ts))


def month_start(ts) -> Column:
    """toStartOfMonth: first day of the month as a date (not a zoned timestamp)."""
    return F.trunc(_c(ts), "MM")


def days_between(start, end) -> Column:
    """dateDiff('day', start, end) = end - start in whole days."""
    return F.date_diff(_c(end), _c(start))


def segment_label(value, p95, p90, median) -> Column:
    """Value segment, highest band first (multiIf)."""
    v = _c(value)
    return (F.when(v >= p95, SEGMENT_WHALE)
             .when(v >= p90, SEGMENT_HIGH)
             .when(v >= median, SEGMENT_MID)
             .otherwise(SEGMENT_STANDARD))


def floor_zero(x) -> Column:
    """greatest(x, 0); NULL counts as no gap."""
    return F.greatest(_c(x), F.lit(0.0))
