"""Sums per period and the period pivot."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sharemill.functions.periods import Windows


def sum_by(df: DataFrame, keys: Iterable[str | Column], measure: str) -> DataFrame:
    """Sum of one measure per key; keys may be expressions with an alias."""
    return df.groupBy(*keys).agg(F.sum(measure).alias(measure))


def period_pivot(
    weekly: DataFrame,
    keys: Iterable[str | Column],
    windows: Windows,
    current: tuple[str, Column],
    trailing: tuple[str, Column],
    year_to_date: tuple[str, Column],
    index: str = "period",
) -> DataFrame:
    """One row per key with three averages over the periods present: current, trailing, year to date.

    Each of the three is (output name, value expression). Keys without rows in a window get NULL there.
    """
    period = F.col(index)
    columns = [
        F.avg(F.when(test, value)).alias(name)
        for test, (name, value) in (
            (windows.is_current(period), current),
            (windows.is_trailing(period), trailing),
            (windows.is_year_to_date(period), year_to_date),
        )
    ]
    return weekly.groupBy(*keys).agg(*columns)
