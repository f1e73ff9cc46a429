"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grain names and the calendar unit each one truncates to.
GRAIN_UNITS = {"daily": "day", "hourly": "hour", "weekly": "week", "monthly": "month"}


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is null, not an error, when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def absolute_zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """Distance from the mean in standard deviations; null without a spread."""
    return F.abs(ratio(value - mean, stddev))


def replace_beyond(value: Column, score: Column, limit: float, other: Column) -> Column:
    """``other`` where the score exceeds the limit; a null score keeps the value."""
    return F.when(score > limit, other).otherwise(value)


def truncate_to_grain(time: Column, grain: str, data_type: str) -> Column:
    """Start of the grain the time falls in; weeks start on Monday.

    ``date_trunc`` always yields a zoned timestamp, so the result is cast back
    to the type of the input.
    """
    truncated = F.date_trunc(GRAIN_UNITS[grain], time)
    return truncated.cast("timestamp_ntz") if data_type == "timestamp_ntz" else truncated
