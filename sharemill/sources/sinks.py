"""Writers. Each is one action; all replace what they write, so a failed run can simply be repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharemill.asof import AsOf

# Folder names of a period and of the "latest" snapshot.
PERIOD_FOLDER = "P_YEAR_OF_WEEK={year}/P_WEEK_NO={week}"
SNAPSHOT_FOLDER = "P_YEAR_OF_WEEK=0000/P_WEEK_NO=00"


def period_path(base: str, asof: AsOf) -> str:
    return f"{base.rstrip('/')}/{PERIOD_FOLDER.format(year=asof.year, week=asof.week)}"


def write_period(df: DataFrame, base: str, asof: AsOf, cluster: Sequence[str] | None = None) -> str:
    """Replace the folder of one period (also with no rows) and return its path. Weeks are not zero-padded.

    By default the rows are written by the tasks that computed them. With ``cluster`` they are shuffled into
    files of ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` first, which pays where a filter leaves most
    tasks with few rows. If it names columns, rows alike in them share files and lie together, so that readers
    filtering on them skip the rest; a combination too large for one file is split.
    """
    path = period_path(base, asof)
    if cluster is not None:
        df = df.hint("rebalance", *cluster)
    if cluster:
        df = df.sortWithinPartitions(*cluster)
    df.write.mode("overwrite").parquet(path)
    return path


def write_periods(df: DataFrame, base: str, year: str = "year_of_week", week: str = "week_no") -> str:
    """Replace the folders of every period that occurs in ``df``; other periods stay.

    Rebalancing by period first keeps the number of files near one per period and splits a period that
    outgrows ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    stamped = df.withColumns({"P_YEAR_OF_WEEK": F.col(year), "P_WEEK_NO": F.col(week)})
    (
        stamped.hint("rebalance", "P_YEAR_OF_WEEK", "P_WEEK_NO")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("P_YEAR_OF_WEEK", "P_WEEK_NO")
        .parquet(base)
    )
    return base


def write_snapshot(df: DataFrame, base: str, files: int | None = None) -> str:
    """Replace the "latest" snapshot and return its path.

    By default the rows are rebalanced: one file while they are few, more as they grow. ``files`` fixes the
    number instead.
    """
    path = f"{base.rstrip('/')}/{SNAPSHOT_FOLDER}"
    gathered = df.hint("rebalance") if files is None else df.repartition(files)
    gathered.write.mode("overwrite").parquet(path)
    return path
