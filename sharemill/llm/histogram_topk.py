"""Exact top-k search by distributed selection over score histograms.

For a block of queries every task scores all its vectors and counts, for each query, how many scores fall into
each bin of that query's current range. The summed histograms tell in which bin the k-th highest score lies, and
that bin becomes the next range, until it is a single score. A last pass keeps the scores above it, and as many
of the equal ones as are needed, by the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sharemill.llm.tables import staged

#: Largest integer up to which doubles are exact: scores proven to stay below it use the fast matrix product.
EXACT = 1 << 53


def quantised(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer matrix) for each vector length in a batch; null and non-finite vectors are left out."""
    vectors = batch.column(1)
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    ok = batch.column(0).is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False)
    ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths[ok]):
        rows = np.flatnonzero(ok & (lengths == length))
        matrix = flat[(ends[rows] - length)[:, None] + np.arange(length)[None, :]]
        finite = np.isfinite(matrix).all(axis=1)
        yield ids[rows[finite]], np.floor(scale * matrix[finite]).astype(np.int64)


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products, exact."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    if top < EXACT:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id",
    embedding: str = "embedding", block: int = 4096, bins: int = 256, tile: int = 1 << 22,
) -> DataFrame:
    """Per query its ``k`` highest scores (all, if fewer): query_id, rank (from 1), vec_id, score (long).

    A component x counts as floor(scale * x); the score is the integer inner product, ties go to the smaller
    vec_id. Candidates are all rows of ``vectors`` whose id is not the query's. Rows with a null id, a null vector,
    or a null or non-finite component take no part; vectors of another length than the query's (also empty
    ones) aren't compared with it. Repeated rows are candidates each; of queries with one id the least vector
    counts. Components must stay below 2**31 after scaling. Empty tables give an empty result.

    Queries are a stated set, taken ``block`` at a time: a block is broadcast (``block`` vectors at most), its
    vectors and ranges pass the driver, and all rows are scored against it in tiles of ``tile`` scores.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("embedding"))
    stated = (
        queries.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
        .where("vec_id is not null and embedding is not null")
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )
    # blocks by hash: even, and each is found again by a filter
    n = stated.count()
    blocks = max(1, -(-n // max(1, block * 3 // 4)))
    stated = staged(stated.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")), "queries")
    found = [
        _block(spark, rows, stated.where(F.col("block") == b), k, scale, bins, tile) for b in range(blocks)
    ]
    return reduce(DataFrame.unionByName, found)


class _Queries:
    """A block of queries of one vector length with their current ranges."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        self.ids, self.matrix, self.low, self.high = ids, matrix, low, high


def _block(spark, rows: DataFrame, stated: DataFrame, k: int, scale: float, bins: int, tile: int) -> DataFrame:
    got = stated.select("vec_id", "embedding").toArrow().combine_chunks()
    batches = got.to_batches() or [pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.list_(pa.float64()))], ["vec_id", "embedding"])]
    own = [x for batch in batches for x in quantised(batch, scale) if x[1].shape[1]]
    groups: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for ids, matrix in own:
        old = groups.get(matrix.shape[1])
        groups[matrix.shape[1]] = (ids, matrix) if old is None else (np.concatenate([old[0], ids]), np.concatenate([old[1], matrix]))
    largest = _largest(rows, scale)
    state = {}
    for length, (ids, matrix) in groups.items():
        # |q . v| <= sum |q_i| * max |v_i|
        bound = np.abs(matrix).sum(axis=1) * max(1, largest)
        state[length] = _Queries(ids, matrix, -bound, bound)
    need = {int(i): k for ids, _ in groups.values() for i in ids}  # how many of the range's highest are wanted
    while any((q.high > q.low).any() for q in state.values()):
        counted = _histogram(spark, rows, state, scale, k, bins, tile)
        from_top = Window.partitionBy("query_id").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
        # at most ``bins`` rows per query, after the sums
        summed = counted.groupBy("query_id", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(from_top))
        wanted = spark.createDataFrame(pa.table({"query_id": list(need), "need": list(need.values())}).to_pandas(), "query_id bigint, need bigint")
        hit = (
            summed.join(wanted, "query_id")
            .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
            .select("query_id", "bin", (F.col("need") - (F.col("upto") - F.col("n"))).alias("need"))
        )
        hits = {r["query_id"]: (r["bin"], r["need"]) for r in hit.collect()}  # a row per query of the block
        for q in state.values():
            width = _width(q, bins)
            for at, i in enumerate(q.ids.tolist()):
                if i not in hits:  # fewer than k candidates in all: keep every one
                    q.high[at] = q.low[at]
                elif q.high[at] > q.low[at]:
                    bin_, need[i] = hits[i]
                    q.low[at] += bin_ * width[at]
                    q.high[at] = min(q.high[at], q.low[at] + width[at] - 1)
    return _select(spark, rows, state, need, scale, k, tile)


def _largest(rows: DataFrame, scale: float) -> int:
    """The largest absolute component after scaling."""

    def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = 0
        for batch in batches:
            for _, matrix in quantised(batch, scale):
                top = max(top, int(np.abs(matrix).max(initial=0)))
        yield pa.RecordBatch.from_arrays([pa.array([top], pa.int64())], ["top"])

    return rows.mapInArrow(most, "top bigint").agg(F.max("top")).first()[0] or 0


def _width(q: _Queries, bins: int) -> np.ndarray:
    return (q.high - q.low) // bins + 1


def _tiles(batches: Iterator[pa.RecordBatch], state: dict[int, _Queries], scale: float, tile: int):
    """(queries, their positions, vector ids, scores with the query's own row marked) tile by tile."""
    for batch in batches:
        for ids, matrix in quantised(batch, scale):
            q = state.get(matrix.shape[1])
            if q is None or not len(ids):
                continue
            step = max(1, tile // len(ids))
            for start in range(0, len(q.ids), step):
                at = np.arange(start, min(start + step, len(q.ids)))
                yield q, at, ids, scores(q.matrix[at], matrix), ids[None, :] != q.ids[at][:, None]


def _histogram(spark, rows: DataFrame, state: dict[int, _Queries], scale: float, k: int, bins: int, tile: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(state)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = sent.value
        totals = {length: np.zeros((len(q.ids), bins), np.int64) for length, q in ranges.items()}
        for q, at, _, values, other in _tiles(batches, ranges, scale, tile):
            low, width = q.low[at][:, None], _width(q, bins)[at][:, None]
            inside = other & (values >= low) & (values <= q.high[at][:, None])
            flat = (np.arange(len(at))[:, None] * bins + np.where(inside, (values - low) // width, 0))[inside]
            totals[q.matrix.shape[1]][at] += np.bincount(flat, minlength=len(at) * bins).reshape(len(at), bins)
        for length, total in totals.items():
            at, bin_ = np.nonzero(total)
            # bins below a task's own k-th highest can't hold the global one
            above = np.cumsum(total[:, ::-1], axis=1)[:, ::-1] - total
            useful = above[at, bin_] < k
            at, bin_ = at[useful], bin_[useful]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges[length].ids[at]), pa.array(bin_.astype(np.int64)), pa.array(total[at, bin_])], ["query_id", "bin", "n"]
            )

    return rows.mapInArrow(count, "query_id bigint, bin bigint, n bigint")


def _select(spark, rows: DataFrame, state: dict[int, _Queries], need: dict[int, int], scale: float, k: int, tile: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(state)
    schema = "query_id bigint, vec_id bigint, score bigint"

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list[np.ndarray]] = {}
        for q, at, ids, values, other in _tiles(batches, sent.value, scale, tile):
            row, col = np.nonzero(other & (values >= q.low[at][:, None]))
            length = q.matrix.shape[1]
            for r, some in zip(*_runs(row), strict=True):
                new = np.stack([-values[r, col[some]], ids[col[some]]])
                old = best.get((length, int(at[r])))
                both = new if old is None else np.concatenate([old, new], axis=1)
                # a task's own best k hold all it can add to the global best k
                best[length, int(at[r])] = both[:, np.lexsort((both[1], both[0]))[:k]]
        found = [(int(sent.value[length].ids[at]), b) for (length, at), b in best.items()]
        for start in range(0, len(found), 4096):
            part = found[start : start + 4096]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat([i for i, _ in part], [b.shape[1] for _, b in part]).astype(np.int64)),
                    pa.array(np.concatenate([b[1] for _, b in part])),
                    pa.array(-np.concatenate([b[0] for _, b in part])),
                ],
                ["query_id", "vec_id", "score"],
            )

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        rows.mapInArrow(keep, schema)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _runs(row: np.ndarray) -> tuple[list[int], list[slice]]:
    """Values of a sorted array, and the slice that holds each."""
    values, starts = np.unique(row, return_index=True)
    ends = np.append(starts, len(row))[1:]
    return values.tolist(), [slice(a, b) for a, b in zip(starts, ends, strict=True)]
