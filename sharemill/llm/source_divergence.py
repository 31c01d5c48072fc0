"""How the sources of a language differ in their words: a dominance skyband before an exact ranking.

Words are counted where they are read; only sums by language, source and word travel. A word's place in the ranking of
a source can only fall as its count in the source falls, its count in the language rises, or its spelling comes later.
So a word that k others dominate in all three is below rank k, whatever the shares are: tasks keep the words that
fewer than k others dominate, merge what they kept, and only those are ranked.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sharemill.llm.tables import staged
from sharemill.llm.words import pieces, utf8

#: Lower-cases A-Z, keeps a-z and all bytes of other letters, makes a space of every other byte.
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))
COUNTED = "lang string, source string, term binary, n bigint, docs bigint"
BAND = "lang string, source string, term string, n bigint, lang_n bigint, value bigint"


@dataclass(frozen=True)
class Audit:
    """A term is kept in a language with so many documents; ``terms`` is the last rank of the part ``term``. The rest
    bounds a task's memory: bytes of text and distinct words between two outputs, words of all its skybands, words of a
    skyband (larger ones are passed on before the task's end, so the words after them meet them in the next step only),
    sources in a tile of a matrix and cells of all matrices."""

    documents: int = 30
    terms: int = 50
    text_bytes: int = 1 << 26
    words: int = 1 << 19
    rows: int = 1 << 18
    batch: int = 1 << 12
    tile: int = 1 << 10
    cells: int = 1 << 23


def divergence(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", audit: Audit = Audit()
) -> DataFrame:
    """Columns lang, source, part, item, value (long), rank (int, from 1 for each group and part).

    ``pair``: each other source of the language, by the sum of the absolute differences of the smoothed shares of all kept
    words; ``term``: the words whose share in the source exceeds that in the language, the largest differences.

    Null text, lang and source are read as ''. Texts without words still make their group. A language without kept words
    has its pairs with value 0, in order of their names. Every row counts as a document, also repeated ones; other
    columns are ignored; an empty table gives an empty table. Results are exact in whole numbers for up to 9e15 words a
    group.

    The pairs of sources are the result asked for; they are all that grows with the square of the sources. The sources
    of one language must fit into one row (an array), and the ranking of one source's pairs in one task.
    """
    slim = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = (
        slim.mapInArrow(lambda batches: _count(batches, audit), COUNTED)
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    kept = staged(
        counted.groupBy("lang", F.col("term").cast("string").alias("term"))
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("found"))
        .where(F.col("docs") >= audit.documents)
        .drop("docs"),
        "divergence-terms",
    )
    groups = staged(_groups(slim, kept), "divergence-groups")
    return _pairs(kept, groups, audit).unionByName(_terms(kept, groups, audit))


def _groups(slim: DataFrame, kept: DataFrame) -> DataFrame:
    """A row for each source of a language: its place among them, and the divisors of its and the language's shares."""
    inside = kept.select("lang", F.explode("found").alias("f")).groupBy("lang", F.col("f.source").alias("source")).agg(F.sum("f.n").alias("n"))
    whole = kept.groupBy("lang").agg(F.sum("lang_n").alias("lang_n"), F.count(F.lit(1)).alias("terms"))
    added = 5 * F.coalesce("terms", F.lit(0))
    return (
        slim.select("lang", "source")
        .distinct()
        .join(inside, ["lang", "source"], "left")
        .join(whole, "lang", "left")
        .select(
            "lang",
            "source",
            (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("place"),
            (F.coalesce("n", F.lit(0)) + added).alias("size"),
            (F.coalesce("lang_n", F.lit(0)) + added).alias("lang_size"),
        )
    )


def share(count: Column, size: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / size), in steps of a thousand so that no product leaves the range of longs."""
    found, rest = F.lit(1).cast("bigint"), count + 5
    for unit in (10**9, 10**6, 10**3, 1):
        found = found + F.call_function("div", rest, size) * F.lit(unit)
        rest = rest % size * 1000
    return found


def _pairs(kept: DataFrame, groups: DataFrame, audit: Audit) -> DataFrame:
    sources = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "source", "size"))).alias("sources"))
    counts = F.map_from_entries("found")
    dense = kept.join(sources, "lang").select(
        "lang",
        F.transform("sources", lambda s: share(F.coalesce(F.element_at(counts, s["source"]), F.lit(0)), s["size"])).alias("shares"),
    )
    tiles = F.sequence(F.lit(0), F.floor((F.size("shares") - 1) / audit.tile).cast("int"))
    sums = (
        dense.select("lang", F.explode(tiles).alias("tile"), "shares")
        .mapInArrow(lambda batches: _distances(batches, audit), "lang string, a int, b int, value bigint")
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"))
    )
    one = groups.select("lang", "source", F.col("place").alias("a"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"))
    pairs = one.join(other, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    return _ranked(pairs, "pair")


def _terms(kept: DataFrame, groups: DataFrame, audit: Audit) -> DataFrame:
    sizes = groups.select("lang", "source", "size", "lang_size")
    found = kept.select("lang", "term", "lang_n", F.explode("found").alias("f")).select("lang", "f.source", "term", "f.n", "lang_n")
    # both tests hold for every word that dominates one for which they hold
    rising = (
        found.join(sizes, ["lang", "source"])
        .withColumn("value", share(F.col("n"), F.col("size")) - share(F.col("lang_n"), F.col("lang_size")))
        .where("n > 0 and value > 0")
        .select("lang", "source", "term", "n", "lang_n", "value")
    )
    bands = rising.mapInArrow(lambda batches: _skybands(batches, audit), BAND)
    # a group's words meet in a few tasks, by their hash, so that none of them holds a whole group
    met = bands.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(8)))
    merged = met.mapInArrow(lambda batches: _skybands(batches, audit), BAND)
    return _ranked(merged.withColumnRenamed("term", "item"), "term", audit.terms)


def _ranked(rows: DataFrame, part: str, last: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if last is not None:  # tasks keep their first rows before the shuffle
        ranked = ranked.where(F.col("rank") <= last)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _count(batches: Iterator[pa.RecordBatch], audit: Audit) -> Iterator[pa.RecordBatch]:
    """Counts of words and of documents with them, by language and source."""
    counts: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}
    read = held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            arrays = [pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()), pa.array([docs[t] for t in n], pa.int64())]
            names = [pa.array([x.decode()], pa.string()).take(pa.array(np.zeros(len(n), np.int32))) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays([*names, *arrays], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*[utf8(batch.column(at)) for at in range(3)], strict=True):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            once: set[bytes] = set()
            before = len(n)
            for piece in pieces(text):
                words = piece.translate(_LETTERS).split()
                n.update(words)
                once.update(words)
            docs.update(once)
            read, held = read + len(text), held + len(n) - before
            if read >= audit.text_bytes or held >= audit.words:
                yield from out()
                counts, read, held = {}, 0, 0
    yield from out()


def _distances(batches: Iterator[pa.RecordBatch], audit: Audit) -> Iterator[pa.RecordBatch]:
    """Sums of absolute differences between the sources of a tile and all sources, by language."""
    sums: dict[tuple[str, int], np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, tile), matrix in sums.items():
            a, b = (x.ravel() for x in np.indices(matrix.shape))
            keep = a + tile * audit.tile != b
            columns = [pa.array((a[keep] + tile * audit.tile).astype(np.int32)), pa.array(b[keep].astype(np.int32)), pa.array(matrix.ravel()[keep])]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(columns[0])), *columns], ["lang", "a", "b", "value"])

    for batch in batches:
        langs, tiles = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows: dict[tuple[str, int], list[int]] = {}
        for at, key in enumerate(zip(langs, tiles, strict=True)):
            rows.setdefault(key, []).append(at)
        for key, places in rows.items():
            width = len(batch.column(2)[places[0]])
            chunk = max(1, audit.cells // 4 // max(width, 1))
            for start in range(0, len(places), chunk):
                part = batch.column(2).take(pa.array(places[start : start + chunk]))
                shares = part.flatten().to_numpy().reshape(-1, width)
                first = key[1] * audit.tile
                found = np.stack([np.abs(shares - shares[:, a : a + 1]).sum(0) for a in range(first, min(first + audit.tile, width))])
                sums[key] = sums[key] + found if key in sums else found
        if sum(m.size for m in sums.values()) > audit.cells:
            yield from out()
            sums = {}
    yield from out()


def skyband(n: np.ndarray, lang_n: np.ndarray, spelling: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others dominate: higher or equal ``n``, lower or equal ``lang_n``, earlier
    ``spelling`` (no two alike).

    Rows are taken in an order in which none comes before one that dominates it. It is enough to count the dominating
    rows among those kept: of a row's dominating ones, the first ``k`` in this order are themselves kept.
    """
    order = np.lexsort((spelling, lang_n, -n))
    kept = np.empty(len(order), np.int64)
    counts, spellings = np.empty(len(order), lang_n.dtype), np.empty(len(order), spelling.dtype)
    size = 0
    for at in order:
        if size < k or np.count_nonzero((counts[:size] <= lang_n[at]) & (spellings[:size] <= spelling[at])) < k:
            kept[size], counts[size], spellings[size] = at, lang_n[at], spelling[at]
            size += 1
    return kept[:size]


def _skybands(batches: Iterator[pa.RecordBatch], audit: Audit) -> Iterator[pa.RecordBatch]:
    """The skyband of each group's words among those of the task, or of a part of them where they are too many."""
    held: dict[tuple[str, str], list[tuple[bytes, int, int, int]]] = {}

    def thinned(rows: list) -> list:
        spelling = np.empty(len(rows), np.int64)
        spelling[sorted(range(len(rows)), key=lambda at: rows[at][0])] = np.arange(len(rows))
        n, lang_n = (np.array([r[at] for r in rows], np.int64) for at in (1, 2))
        return [rows[at] for at in skyband(n, lang_n, spelling, audit.terms)]

    def out(key: tuple[str, str], rows: list) -> pa.RecordBatch:
        terms, *numbers = zip(*rows, strict=True)
        names = [pa.array([name] * len(rows)) for name in key]
        columns = [*names, pa.array(terms, pa.binary()).cast(pa.string()), *[pa.array(x, pa.int64()) for x in numbers]]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "lang_n", "value"])

    for batch in batches:
        langs, sources, *numbers = [batch.column(at).to_pylist() for at in (0, 1, 3, 4, 5)]
        for lang, source, *row in zip(langs, sources, utf8(batch.column(2)), *numbers, strict=True):
            key = lang, source
            rows = held.setdefault(key, [])
            rows.append(tuple(row))
            if len(rows) >= 2 * audit.batch:
                held[key] = thinned(rows)
                if len(held[key]) > audit.batch:  # few dominate each other: no more memory or time for these
                    yield out(key, held.pop(key))
        if sum(map(len, held.values())) > audit.rows:
            for key, rows in held.items():
                yield out(key, thinned(rows))
            held = {}
    for key, rows in held.items():
        yield out(key, thinned(rows))
