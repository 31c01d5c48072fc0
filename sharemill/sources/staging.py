"""Intermediate results as written tables, and who deletes them.

A step that is read several times is written once. Its readers then share one pass over the facts for certain
(sharing exchanges is up to the planner), their plans stay small, Spark knows the true size of what they read,
and a lost executor costs no recomputation of the steps before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines see: ``spark.checkpoint.dir``. On one machine (master ``local``) it may be unset; then it is
    a folder in the warehouse."""
    if folder := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster see")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder. Nobody deletes it: lazy results may still read it. Whoever knows when
    they are done takes a path from a ``Staging`` instead."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` (one job) and return the written table, which stays."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Staging:
    """Owns the intermediate tables of one job and deletes them when it ends, whether it succeeds or fails.

        with Staging(spark) as staging:
            sums = staging.table(sums, "sums")
            write_snapshot(mart(sums), path)

    Results that are still lazy when it ends can't be read any more: write them inside.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        #: What is there to delete, oldest first.
        self.folders: list[str] = []

    def folder(self, label: str) -> str:
        self.folders.append(new_folder(self.spark, label))
        return self.folders[-1]

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` (one job) and return the written table. A table that fails half-way is deleted with the others."""
        folder = self.folder(label)
        df.write.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def close(self) -> None:
        while self.folders:
            remove(self.spark, self.folders.pop())

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *error) -> None:
        self.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def period_times(spark: SparkSession, base: str) -> dict[tuple[int, int], int]:
    """(year, week) of every period folder below ``base`` -> time of its newest file, in milliseconds."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{base.rstrip('/')}/P_YEAR_OF_WEEK=*/P_WEEK_NO=*")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for period in files.globStatus(folder) or ():
        year, week = (int(part.split("=")[1]) for part in period.getPath().toString().rstrip("/").split("/")[-2:])
        times = [file.getModificationTime() for file in files.listStatus(period.getPath())]
        if times:
            found[year, week] = max(times)
    return found
