"""Opening tables and cutting them to one period."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sharemill.asof import AsOf
from sharemill.operators.checks import as_declared


def open_table(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """A catalog table (``database.table``) or, if the name holds a slash, a Parquet folder.

    Columns of other types than the declared ones are cast to them. Partition columns in folder names are added by
    Spark.
    """
    table = spark.read.parquet(name) if "/" in name else spark.read.table(name)
    return table if schema is None else as_declared(table, schema)


def written_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A folder that this package wrote: its schema is known, so the reader needs no job to infer it."""
    return spark.read.schema(schema).parquet(path)


def period_slice(df: DataFrame, asof: AsOf, year: str = "year_of_week", week: str = "week_no") -> DataFrame:
    """Rows of one period. Compares with text literals, so text columns match exactly (``05`` is not ``5``)
    and number columns by value; on partition columns this prunes folders."""
    return df.where((F.col(year) == str(asof.year)) & (F.col(week) == str(asof.week)))
