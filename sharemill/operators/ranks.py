"""Competition ranking (ties share a rank, the next rank has a gap), highest value first, NULL last."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, IntegralType


def rank_few(df: DataFrame, value: str, keys: Iterable[str] = (), rank: str = "rank") -> DataFrame:
    """Rank within ``keys`` (or over all rows), a group in one task: only where the rules bound a group's rows."""
    return df.withColumn(rank, F.rank().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(value))))


#: A value's place has 64 bits; these many of the lowest are cut off for the prefixes by which tasks divide the values.
CUTS = (42, 21)
#: Digits of a decimal number that its place holds.
DIGITS = 18


def rank_many(df: DataFrame, value: str, keys: Iterable[str] = (), rank: str = "rank") -> DataFrame:
    """Rank within ``keys`` (or over all rows) for groups of any size, as one lazy plan.

    A row's rank is one more than the number of rows of its group with a higher value. Equal values are counted
    together first, with partial counts before the shuffle, so ties may be of any size. Every value has a place, a
    number of 64 bits in the order of the values, and prefixes of it: rows above a value = rows under higher first
    prefixes + rows under higher second prefixes of its first one + rows with higher values under its second one. No
    task sorts more than the prefixes (at most 2^22) or the values (2^21) under one prefix, however the values lie, so
    there is no sample, and nothing to be written for all readers to agree on. Decimals of more than 18 digits have a
    third prefix, their first 18 digits, under which lie at most as many values as the other digits can tell apart.
    """
    keys = list(keys)
    # a struct is equal to another with NULL in the same fields, and is itself never NULL
    group, groups = ([F.struct(*keys).alias("_group")], ["_group"]) if keys else ([], [])
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumns(prefixes(F.col(value), df.schema[value].dataType))
    levels = [name for name in counts.columns if name.startswith("_prefix_")]

    sums = counts
    nodes = {}
    for depth in range(len(levels), 0, -1):
        sums = sums.groupBy(*groups, *levels[:depth]).agg(F.sum("_n").alias("_n"))
        nodes[depth] = sums
    above = None
    for depth, level in enumerate([*levels, value], 1):
        parents = [*groups, *levels[: depth - 1]]
        here = nodes.get(depth, counts).withColumn("_here", _before(Window.partitionBy(*parents).orderBy(F.desc_nulls_last(level))))
        if above is not None:
            here = here.join(above, parents).withColumn("_here", F.col("_here") + F.col("_above"))
        above = here.select(*groups, *levels[:depth], *([value] if level == value else []), F.col("_here").alias("_above"))
    same = F.struct(*[F.col(f"_group.{key}").alias(key) for key in keys], value)
    ranked = above.select(same.alias("_same"), (F.col("_above") + 1).cast("int").alias(rank))
    return df.withColumn("_same", F.struct(*keys, value)).join(ranked, "_same").select(*df.columns, rank)


def _before(order) -> Column:
    return F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def prefixes(value: Column, kind: DataType) -> dict[str, Column]:
    """Prefixes of a value's place, widest cut first, never NULL: those of a NULL are below all others."""
    at = place(value, kind)
    cuts = [*CUTS, 0] if isinstance(kind, DecimalType) and kind.precision > DIGITS else CUTS
    lowest = -(2**63)
    return {
        f"_prefix_{depth}": F.coalesce(F.shiftright(at, cut), F.lit((lowest >> cut) - 1 if cut else lowest)) for depth, cut in enumerate(cuts)
    }


def place(value: Column, kind: DataType) -> Column:
    """A 64-bit number that never falls as the value rises; equal only for equal values, but for wide decimals."""
    if isinstance(kind, DecimalType):
        shift = min(kind.scale, DIGITS - kind.precision + kind.scale)
        unit = F.lit(Decimal(10 ** abs(shift)))
        return F.floor(value * unit if shift >= 0 else value / unit).cast("bigint")
    if isinstance(kind, IntegralType):
        return value.cast("bigint")
    if not isinstance(kind, (DoubleType, FloatType)):
        raise TypeError(f"only numbers have a place, not {kind.simpleString()}")
    number = value.cast("double")
    # the number's own bits, from its exact form "0x1.8p-3"
    form = F.format_string("%a", F.abs(number))
    exponent = F.substring_index(form, "p", -1).try_cast("int")
    fraction = F.conv(F.rpad(F.substring_index(F.substring_index(form, "p", 1), ".", -1), 13, "0"), 16, 10).try_cast("bigint")
    scale = F.when(F.substring(form, 3, 1) == "0", F.lit(0)).otherwise(exponent + 1023).cast("bigint")
    infinity = 0x7FF << 52
    bits = (
        F.when(F.isnan(number), F.lit(infinity + 1))
        .when(F.abs(number) == float("inf"), F.lit(infinity))
        .otherwise(F.shiftleft(scale, 52) + fraction)
    )
    return F.when(number < 0, -bits).otherwise(bits)
