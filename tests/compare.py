"""Runs a query's SQL on DuckDB and compares it with the Spark result: names, types, and every value."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame


def sql_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    engine = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        engine.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return engine


def _kinds(table: pa.Table) -> dict[str, str]:
    return {field.name: str(field.type).removeprefix("large_") for field in table.schema}


def _value(value):
    if isinstance(value, Decimal):
        return value.normalize()
    if isinstance(value, float):
        return "nan" if value != value else value
    return value


def _rows(table: pa.Table) -> Counter:
    columns = [[_value(value) for value in table.column(name).to_pylist()] for name in sorted(table.column_names)]
    return Counter(zip(*columns))


def differences(result: DataFrame, engine: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, in words; empty if nothing does."""
    ours = result.toArrow()
    theirs = engine.sql(sql).to_arrow_table()
    found = []
    if _kinds(ours) != _kinds(theirs):
        found.append(f"columns: {_kinds(ours)} / {_kinds(theirs)}")
        if set(ours.column_names) != set(theirs.column_names):
            return found
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows: {ours.num_rows} / {theirs.num_rows}")
    left, right = _rows(ours), _rows(theirs)
    if left != right:
        found.append(f"only in Spark: {list((left - right).items())[:3]}")
        found.append(f"only in SQL: {list((right - left).items())[:3]}")
    return found
