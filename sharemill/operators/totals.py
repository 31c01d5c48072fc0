"""Totals next to the rows they are totals of, and normalisation by them.

``partition_total`` and ``normalise_100`` gather no group in one task: the total is aggregated (with partial sums before
the shuffle) and then attached, so a group may be of any size, but the rows are computed twice, for the total and for
themselves. Where few rows are known to be left, ``total_few`` and ``normalise_kept`` compute them once.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sharemill.functions.measures import fixed_point, percent_of


def partition_total(df: DataFrame, keys: Iterable[str], measure: str, total: str) -> DataFrame:
    """Add the sum of ``measure`` over all rows with the same keys; NULL keys form a group of their own."""
    keys = list(keys)
    totals = df.groupBy(*[F.col(key).alias(f"_{key}") for key in keys]).agg(F.sum(measure).alias(total))
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    return df.join(totals, same, "inner").select(*df.columns, total)


def normalise_100(df: DataFrame, measures: Iterable[str], overflow: str = "raise") -> DataFrame:
    """Replace each measure by its percentage of the measure's sum over all rows, as DECIMAL(18,7).

    The sums come from one single-row scalar subquery, so the rows stay where they are.
    """
    measures = list(measures)
    sums = df.agg(F.struct(*[F.sum(name).alias(name) for name in measures])).scalar()
    return df.withColumns(
        {name: fixed_point(percent_of(F.col(name), sums.getField(name)), overflow) for name in measures}
    )


def total_few(df: DataFrame, keys: Iterable[str], measure: str, total: str) -> DataFrame:
    """``partition_total`` in one pass, a group in one task: for sums, of which a group has a row for each name only."""
    return df.withColumn(total, F.sum(measure).over(Window.partitionBy(*keys)))


def normalise_kept(df: DataFrame, measures: Iterable[str], kept: Column, overflow: str = "raise") -> DataFrame:
    """``normalise_100`` over all rows and then only the rows that pass ``kept``, which must be few: one aggregation has
    the sums of all rows and carries the few along."""
    measures = list(measures)
    row = F.struct(*df.columns)
    sums = F.struct(*[F.sum(name).alias(name) for name in measures]).alias("_sums")
    rows = df.agg(sums, F.collect_list(F.when(kept, row)).alias("_rows")).select("_sums", F.explode("_rows").alias("_row"))
    shares = {name: fixed_point(percent_of(F.col(f"_row.{name}"), F.col(f"_sums.{name}")), overflow) for name in measures}
    return rows.select(*[shares[name].alias(name) if name in shares else F.col(f"_row.{name}") for name in df.columns])
