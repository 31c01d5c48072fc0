"""Data checks as real jobs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def check_schema(df: DataFrame, expected: StructType) -> DataFrame:
    """Fail on missing columns or other types; extra columns and nullability do not matter."""
    actual = {field.name.lower(): field.dataType for field in df.schema.fields}
    problems = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        + (f"found {found.simpleString()}" if (found := actual.get(field.name.lower())) else "missing")
        for field in expected.fields
        if actual.get(field.name.lower()) != field.dataType
    ]
    if problems:
        raise ValueError("schema check failed: " + "; ".join(problems))
    return df


def as_declared(df: DataFrame, declared: StructType) -> DataFrame:
    """Cast columns to their declared types where they have others (a week kept as int); fail on missing ones."""
    actual = {field.name.lower(): field.dataType for field in df.schema.fields}
    missing = [field.name for field in declared.fields if field.name.lower() not in actual]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    other = [field for field in declared.fields if actual[field.name.lower()] != field.dataType]
    return df.withColumns({field.name: F.col(f"`{field.name}`").cast(field.dataType) for field in other})


def preview(df: DataFrame, rows: int, order: Iterable[str | Column]) -> DataFrame:
    """The first rows under a total order."""
    return df.orderBy(*order).limit(rows)


def check_total(df: DataFrame, measure: str, name: str | None = None) -> DataFrame:
    """One row: the sum of a measure."""
    return df.agg(F.sum(measure).alias(name or f"sum_{measure}"))


def check_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """One row: the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(name))


def duplicate_keys(master: DataFrame, key: Column) -> DataFrame:
    """Key values that occur more than once, with their counts (NULL keys never match and do not count)."""
    return (
        master.groupBy(key.alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("key").isNotNull())
    )


def with_unique_key(master: DataFrame, key: Column) -> DataFrame:
    """The same rows, or a failing job if ``key`` repeats. Lazy: the check runs inside the job that reads it."""
    repeats = duplicate_keys(master, key).agg(F.count(F.lit(1))).scalar()
    failure = F.raise_error(F.concat(F.lit("duplicate master keys: "), repeats.cast("string")))
    return master.where(F.when(repeats == 0, F.lit(True)).otherwise(failure.cast("boolean")))


def disagreeing_weeks(feed: DataFrame, first: str = "week", second: str = "week_no") -> DataFrame:
    """Rows whose two week columns differ."""
    left, right = F.col(first).try_cast("bigint"), F.col(second).try_cast("bigint")
    return feed.where(~left.eqNullSafe(right))


def rejected_numbers(feed: DataFrame, texts: Iterable[str], cleaned) -> DataFrame:
    """Rows with a text that ``cleaned`` (Column -> Column, lenient) could not turn into a number."""
    bad = F.lit(False)
    for name in texts:
        bad = bad | cleaned(F.col(f"`{name}`")).isNull()
    return feed.where(bad)
