"""Reading inputs, and intermediate results as written tables in the folder that all machines share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sharemill.llm.words import binary, utf8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines see: ``spark.checkpoint.dir``. On one machine (master ``local``) it may be unset; then it is
    a folder in the warehouse."""
    if folder := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return folder.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster see")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def write_staged(df: DataFrame, label: str) -> str:
    """Write ``df`` as Parquet (one job) below the shared folder and return the path."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table: later steps read it, and recompute nothing when an executor is lost.

    The files stay, because lazy results read them; the owner of the shared folder removes them.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_staged(df, label))


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def merged(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the input, by sorting them.

    Left to itself Spark judges a table by its compressed bytes: one below the limit for broadcasts can have millions of
    rows, and the driver makes a hash table of them more than ten times as large, several at once.
    """
    return left.join(right.hint("merge"), on, how)


def fresh(names: Iterable[str], wanted: str) -> str:
    """``wanted``, or with underscores appended until no column has that name (ignoring case)."""
    taken = {name.lower() for name in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def quoted(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Bytes of text that are chosen from at once.
CHOSEN = 1 << 20


def chosen_by_text(docs: DataFrame, text: str, chooser: Callable[[], Callable[[list[bytes | None]], list[bool]]]) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts are chosen by a function that ``chooser`` makes once a task.

    Columns go through Arrow under plain names, because there Spark takes none with dots or backticks. Each goes once, and
    of a batch only the texts of about ``CHOSEN`` bytes are held besides.
    """
    fields = [StructField(f"c{at}", f.dataType, f.nullable, f.metadata) for at, f in enumerate(docs.schema)]
    docs.select(quoted(text))  # fails here if there is no such column, or several
    place = docs.columns.index(text) if text in docs.columns else [c.lower() for c in docs.columns].index(text.lower())

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = chooser()
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(binary(batch.column(place))), 0)
            ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(ends // CHOSEN)) + 1).tolist(), batch.num_rows]
            for start, end in pairwise(cuts):
                part = batch.slice(start, end - start)
                yield part.filter(pa.array(chosen(utf8(part.column(place))), pa.bool_()))

    return docs.toDF(*[f.name for f in fields]).mapInArrow(choose, StructType(fields)).toDF(*docs.columns)


def numbered(df: DataFrame, keys: list[Column], label: str, position: str = "position") -> DataFrame:
    """Rows with their position (long, from 0) in the order of ``keys``.

    Rows are range-partitioned and sorted within their partition, so that no task holds more than one range;
    ``keys`` should tell rows apart, else equal rows come in an arbitrary order and share a range. The numbered
    ranges are written once, hence all readers see one numbering; the partitions' offsets are added by a join.
    """
    raw = fresh(df.columns, "_raw_id")
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    written = staged(ranged.withColumn(raw, F.monotonically_increasing_id()), label)
    part, row = F.shiftrightunsigned(raw, 33), F.col(raw).bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        # one row per partition
        written.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    marked = written.withColumn("_part", part).withColumn(position, row)
    return marked.join(offsets, "_part").withColumn(position, F.col(position) + F.col("_offset")).drop("_part", "_offset", raw)
