"""Steps over dimension columns: trimming, projection, row filters on names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sharemill.functions.classify import has_prefix, in_names
from sharemill.functions.text import contains_marker


def trim_dims(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip spaces (not tabs) from both ends of the named columns, leaving out those the frame lacks."""
    present = {name.lower() for name in df.columns}
    return df.withColumns({name: F.trim(F.col(name)) for name in columns if name.lower() in present})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep and rename columns: new name -> old name, in this order."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in names.items()])


def filter_eq(df: DataFrame, values: Mapping[str, str], trimmed: bool = False) -> DataFrame:
    """Rows whose columns equal the given texts exactly.

    With ``trimmed`` the comparison ignores surrounding spaces. A computed comparison cannot reach the
    Parquet scan, so a weaker test that it implies goes along with it: the text starts with the value or with
    a space. The scan can check that against minimum and maximum and skip row groups and pages.
    """
    for name, value in values.items():
        column = F.col(name)
        if trimmed:
            df = df.where((column.startswith(value) | column.startswith(" ")) & (F.trim(column) == value))
        else:
            df = df.where(column == value)
    return df


def exclude_marker(df: DataFrame, column: str, marker: str = "(na)", ignore_case: bool = False) -> DataFrame:
    """Drop rows whose column contains the marker; rows with NULL there go too."""
    return df.where(~contains_marker(F.col(column), marker, ignore_case))


def exclude_zero(df: DataFrame, column: str, drop_zero: bool = False) -> DataFrame:
    """Drop rows whose number renders as ``0.00``.

    A double zero renders as ``0.0``, so the default removes no number (only NULL); ``drop_zero`` compares
    the number itself.
    """
    value = F.col(column)
    return df.where(value != 0) if drop_zero else df.where(value.isNotNull())


def keep_members(df: DataFrame, column: str, members: Iterable[str] | DataFrame) -> DataFrame:
    """Rows whose upper-cased name is listed: inline names, or a one-column table of upper-case names."""
    if not isinstance(members, DataFrame):
        return df.where(in_names(F.col(column), members))
    names = members.toDF("_member")
    return df.join(names, F.upper(F.col(column)) == F.col("_member"), "left_semi")


def keep_groups(df: DataFrame, column: str, labels: Iterable[str]) -> DataFrame:
    """Rows whose upper-cased label is one of ``labels``."""
    return df.where(in_names(F.col(column), labels))


def keep_prefixes(df: DataFrame, column: str, prefixes: Iterable[str]) -> DataFrame:
    """Rows whose upper-cased label starts with one of ``prefixes``."""
    return df.where(has_prefix(F.col(column), prefixes))


def drop_any_null(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL or NaN anywhere.

    Spelled out per column: unlike the one predicate of ``na.drop()``, these can sink below joins to the scan.
    """
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        df = df.where(column.isNotNull())
        if isinstance(field.dataType, (DoubleType, FloatType)):
            df = df.where(~F.isnan(column))
    return df
