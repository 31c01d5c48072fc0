"""How quality filters interact, from sorted posting lists.

Every document is measured once. For a part and a range of its documents, each filter has the sorted list of the ids
it fails. Unions of lists are galloping merges (each id of the shorter list is searched in the longer one from where
the id before it was found), what a filter removes after others is its list without their union. Ranges are disjoint,
so the sizes of these lists add up over ranges, and all 120 orders are read from 80 sums for each part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sharemill.llm.tables import staged
from sharemill.llm.words import pieces, utf8

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
MEASURED = "doc_id bigint, part string, fails int, digest binary"
SIZES = ("documents", "failing", "union_size", "removed", "good_lost", "toxic_lost")

_CAPITALS = bytes(range(0x41, 0x5B))
_CONTINUED = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Limits:
    """A text fails A with fewer words, B with a smaller share of distinct words, C with a larger share of capitals
    (both in percent), D with any of the signs, E if a smaller id has the same text. ``span`` is the number of
    documents whose lists a task holds at a time."""

    words: int = 200
    distinct: int = 50
    capitals: int = 2
    signs: bytes = b"#$%&*|"
    span: int = 1 << 16


def filter_audit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source", limits: Limits = Limits()
) -> DataFrame:
    """For each part, each order of the five filters and each step: what its filter does there.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley, all but
    the first three long, counted in documents of the part, zeros included.

    A null text is an empty one (no words; fails A only, and E if a smaller id is empty or null too); a null part is the
    empty string. A document counts as good or toxic if any label row of its id says so (``labels``: doc_id, quality,
    toxic); other ids and null ids of ``labels`` don't matter. Repeated rows count each, and don't make each other fail
    E, as their ids are equal. A row with a null id counts, never fails E and makes none fail it. Texts are compared by
    SHA-256. Other columns are ignored; an empty table gives an empty table.
    """
    slim = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(text).alias("text"),
    )
    measured = staged(
        slim.mapInArrow(lambda batches: _measure(batches, limits), MEASURED).withColumn("row", F.monotonically_increasing_id()), "filter-audit"
    )
    # the smallest id of each text; the join back is by id, so that a text that many documents share is no hot key
    firsts = measured.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").alias("quality"), F.col("toxic").alias("toxic"))
        .where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    copies = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), F.lit(1 << 4)).otherwise(F.lit(0))
    order = ["part", "doc_id", "row"]
    failing = (
        measured.join(firsts, ["doc_id", "digest"], "left")
        .join(marks, "doc_id", "left")
        .select(*order, F.col("fails").bitwiseOR(copies).alias("fails"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    )
    # in order of part and id, a task holds ranges of ids one after the other, however many documents a part has
    ranges = failing.repartitionByRange(*order).sortWithinPartitions(*order).select("part", "fails", "good", "toxic")
    schema = "part string, earlier int, filter int, " + ", ".join(f"{name} bigint" for name in SIZES)
    sizes = ranges.mapInArrow(lambda batches: _audit(batches, limits.span), schema)
    summed = sizes.groupBy("part", "earlier", "filter").agg(*[F.sum(name).alias(name) for name in SIZES])
    return _orders(summed)


def _orders(sums: DataFrame) -> DataFrame:
    """The 600 rows of each part from its 80 sums."""
    n = len(FILTERS)
    # in how many orders a filter has exactly the filters of the set ``earlier`` before it
    weight = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), (F.bit_count("earlier") + 1).cast("int"))
    own = Window.partitionBy("part", "filter")  # 16 rows
    others = F.lit(ALL).bitwiseXOR(F.expr("shiftleft(1, filter)"))
    sums = sums.withColumns(
        {
            "shapley": F.sum(F.col("removed") * weight).over(own),
            "unique_fails": F.sum(F.when(F.col("earlier") == others, F.col("removed"))).over(own),
        }
    )
    steps = [
        (sum(1 << FILTERS.index(x) for x in order[:at]), FILTERS.index(name), "".join(order), at + 1)
        for order in permutations(FILTERS)
        for at, name in enumerate(order)
    ]
    table = sums.sparkSession.createDataFrame(steps, "earlier int, filter int, filter_order string, step int")
    return sums.join(F.broadcast(table), ["earlier", "filter"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - F.col("union_size")).alias("kept"),
        "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )


def failed(text: bytes, limits: Limits = Limits()) -> int:
    """Bits of the filters A to D that a text fails (bit 0 for A)."""
    words, distinct = 0, set()
    for piece in pieces(text):
        found = piece.split()
        words += len(found)
        distinct.update(found)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUED))
    tests = (
        words < limits.words,
        100 * len(distinct) < limits.distinct * words,
        100 * capitals > limits.capitals * points,
        len(text.translate(None, limits.signs)) < len(text),
    )
    return sum(1 << at for at, test in enumerate(tests) if test)


def _measure(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in utf8(batch.column(2))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([failed(t, limits) for t in texts], pa.int32()),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            ],
            ["doc_id", "part", "fails", "digest"],
        )


def without(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The ids of one sorted list that another sorted list doesn't have."""
    if not len(others) or not len(ids):
        return ids
    return ids[~_in(ids, others)]


def common(ids: np.ndarray, others: np.ndarray) -> int:
    """How many ids two sorted lists share."""
    if len(ids) > len(others):
        ids, others = others, ids
    return int(np.count_nonzero(_in(ids, others))) if len(ids) else 0


def merged(lists: list[np.ndarray]) -> np.ndarray:
    """The union of sorted lists, from the shortest to the longest."""
    out, *rest = sorted(lists, key=len)
    for longer in rest:
        new = without(out, longer) if len(out) <= len(longer) else without(longer, out)
        base = longer if len(out) <= len(longer) else out
        # every new id goes to its place in the other list, the stretches between are copied whole
        out = np.insert(base, np.searchsorted(base, new), new) if len(new) else base
    return out


def _in(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    # searchsorted starts each search of ascending keys from the place of the one before
    at = np.searchsorted(others, ids)
    at[at == len(others)] = len(others) - 1
    return others[at] == ids


def list_sizes(fails: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Sizes for one range of documents: a row for each set of earlier filters and each filter not in it, SIZES across."""
    lists = [np.flatnonzero(fails & (1 << at)) for at in range(len(FILTERS))]
    kinds = np.flatnonzero(good), np.flatnonzero(toxic)
    unions = {0: np.empty(0, np.int64)}
    for mask in range(1, ALL + 1):
        top = mask.bit_length() - 1
        unions[mask] = merged([unions[mask ^ (1 << top)], lists[top]])
    rows = []
    for mask, at in STEPS:
        removed = without(lists[at], unions[mask])
        rows.append((len(fails), len(lists[at]), len(unions[mask | 1 << at]), len(removed), *[common(removed, kind) for kind in kinds]))
    return np.array(rows, np.int64)


STEPS = [(mask, at) for mask in range(ALL + 1) for at in range(len(FILTERS)) if not mask >> at & 1]


def _audit(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by part; the sizes of a part are summed over the ranges of the task."""
    part, held, total = None, [], None

    def close() -> None:
        nonlocal total, held
        if held:
            found = list_sizes(*[np.concatenate(x) for x in zip(*held, strict=True)])
            total, held = found if total is None else total + found, []

    def out() -> pa.RecordBatch:
        earlier, filters = zip(*STEPS, strict=True)
        arrays = [pa.array([part] * len(STEPS)), pa.array(earlier, pa.int32()), pa.array(filters, pa.int32())]
        return pa.RecordBatch.from_arrays([*arrays, *[pa.array(x) for x in total.T]], ["part", "earlier", "filter", *SIZES])

    for batch in batches:
        names = batch.column(0).dictionary_encode()
        codes = names.indices.to_numpy()
        columns = [batch.column(at).to_numpy() for at in (1, 2, 3)]
        cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1), len(codes)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if start == end:
                continue
            name = names.dictionary[codes[start]].as_py()
            if name != part:
                close()
                if total is not None:
                    yield out()
                part, total = name, None
            for at in range(start, end, span):
                held.append([c[at : min(at + span, end)] for c in columns])
                if sum(len(x[0]) for x in held) >= span:
                    close()
    close()
    if total is not None:
        yield out()
