"""Expressions over measures: fixed point, truncation, zero fill, shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEASURE = "decimal(18,7)"


def fixed_point(value: Column, overflow: str = "raise") -> Column:
    """To DECIMAL(18,7), rounding half up; NaN becomes NULL.

    A value that does not fit follows the session's ANSI mode, or becomes NULL with ``overflow="null"``.
    """
    return value.try_cast(MEASURE) if overflow == "null" else value.cast(MEASURE)


def truncate6(value: Column, null_measures: str = "keep") -> Column:
    """Cut to six decimals towards minus infinity, as double. Meant for decimals and finite doubles."""
    cut = F.floor(value * 1000000).cast("double") / F.lit(1e6)
    if null_measures == "keep":
        return cut
    if null_measures != "fail":
        raise ValueError(f"null_measures must be 'keep' or 'fail', got {null_measures!r}")
    return F.coalesce(cut, F.raise_error(F.lit("measure is NULL")).cast("double"))


def null_to_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def percent_of(value: Column, total: Column) -> Column:
    """``value`` as a percentage of ``total``; NULL where the total is zero, in any ANSI mode."""
    return F.try_divide(value * 100, total)
