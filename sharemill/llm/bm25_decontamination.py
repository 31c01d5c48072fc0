"""Benchmark decontamination by an inverted index of the test items.

The items are indexed by their words with BM25 impacts, scaled so that an item scores 1 against itself. Every
passage of every text is a query, and all items that score at least the threshold are wanted. As in block-max
WAND, items come in blocks with the largest impact of each word in the block; a block is opened only if the sum of
these bounds over the passage's words reaches the threshold. Words found in many blocks aren't looked up: they add
at most the sum of their largest impacts, and at most what all such words weigh in an item of the block. (An item
in which these alone reach the threshold has all its words looked up.) Items retrieved are confirmed on runs of
words of question and answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharemill.llm.tables import chosen_by_text, quoted, staged
from sharemill.llm.words import pieces, utf8

#: The usual BM25 constants.
K1, B = 1.2, 0.75
#: Other ASCII than letters and digits separates words.
_TABLE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
ITEM = "uid bigint, item_id bigint, question array<binary>, answer array<binary>"
HIT = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


@dataclass(frozen=True)
class Settings:
    """Least scaled score of a passage; least share of the runs of ``gram`` words that question and answer each must
    have in the passage; items of a block; share of the items beyond which a word is common and isn't looked up (for
    every item that others words can bring to the threshold); words of the items in one broadcast (which bounds it:
    under 200 bytes a word)."""

    threshold: float = 0.5
    overlap: float = 0.5
    gram: int = 5
    block: int = 2
    common: float = 0.03
    words: int = 1_000_000


def plain(text: bytes) -> list[bytes]:
    """Words in lower case, without punctuation."""
    return text.decode(errors="replace").lower().encode().translate(_TABLE).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The answer is what follows the last question mark, else the last sentence, else the last third of the words."""
    head, mark, tail = text.rpartition("?")
    if not mark or not plain(tail.encode()):
        sentences = _SENTENCE.split(text.strip())
        head, tail = " ".join(sentences[:-1]), sentences[-1]
    question, answer = plain(head.encode()), plain(tail.encode())
    if not question or not answer:
        words = question + answer
        cut = len(words) - len(words) // 3
        question, answer = words[:cut], words[cut:]
    return question, answer


@dataclass
class Shard:
    """The index of items of similar length; passages take three halves of ``half`` words, so that every run of
    words as long as an item lies in one."""

    half: int
    vocabulary: dict[bytes, int]
    items: list[tuple[int, list[bytes], list[bytes]]]  # item_id, question, answer
    terms: list[np.ndarray]  # by item, sorted
    impacts: list[np.ndarray]
    block: int
    starts: np.ndarray  # postings of a term: blocks and largest impacts there
    blocks: np.ndarray
    bounds: np.ndarray
    largest: np.ndarray  # by term: among the postings that aren't looked up
    rest: np.ndarray  # by block: what the words that aren't looked up weigh at most in an item


def _shard(rows: list, count: int, mean: float, settings: Settings) -> Shard:
    """The index of some items, given how many items there are and their mean number of words."""
    vocabulary: dict[bytes, int] = {}
    # items that share their rarest words come together, which keeps the bounds of their block low
    rows = sorted(rows, key=lambda r: (min((x["df"], bytes(x["word"])) for x in r["words"]), r["uid"]))
    items, terms, impacts = [], [], []
    for r in rows:
        question, answer = ([bytes(w) for w in r[k]] for k in ("question", "answer"))
        words = question + answer
        frequency = {bytes(x["word"]): x["df"] for x in r["words"]}
        tf = {w: words.count(w) for w in frequency} if len(words) < 200 else dict(zip(*np.unique(np.array(words, object), return_counts=True), strict=True))
        norm = K1 * (1 - B + B * len(words) / mean)
        weight = {w: np.log1p((count - df + 0.5) / (df + 0.5)) * tf[w] * (K1 + 1) / (tf[w] + norm) for w, df in frequency.items()}
        at = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in weight])
        value = np.array(list(weight.values()))
        order = np.argsort(at)
        items.append((r["item_id"], question, answer))
        terms.append(at[order])
        impacts.append((value / value.sum())[order])
    item = np.repeat(np.arange(len(items)), [len(t) for t in terms])
    term, impact = np.concatenate(terms), np.concatenate(impacts)
    # words of many items aren't looked up, but for items that would reach the threshold by them alone
    common = (np.bincount(term) > max(1, settings.common * len(items)))[term]
    weight = np.bincount(item, np.where(common, impact, 0), len(items))
    common &= (weight < settings.threshold)[item]
    block, n_blocks = item // settings.block, -(-len(items) // settings.block)
    rest = np.maximum.reduceat(np.where(weight < settings.threshold, weight, 0), np.arange(0, len(items), settings.block))
    largest = np.zeros(len(vocabulary))
    np.maximum.at(largest, term[common], impact[common])
    found, where = np.unique(term[~common] * n_blocks + block[~common], return_inverse=True)
    bounds = np.zeros(len(found))
    np.maximum.at(bounds, where, impact[~common])
    starts = np.searchsorted(found // n_blocks, np.arange(len(vocabulary) + 1))
    longest = max(len(q) + len(a) for _, q, a in items)
    return Shard(max(8, -(-longest // 2)), vocabulary, items, terms, impacts, settings.block, starts, found % n_blocks, bounds, largest, rest)


class _Search:
    """Passages against the shards."""

    def __init__(self, shards: list[Shard], settings: Settings) -> None:
        self.shards, self.settings = shards, settings
        self.overlap = max((3 * s.half for s in shards), default=0)

    def texts(self, texts: list[bytes | None]) -> dict[tuple[int, int, int], tuple[int, float, float, float]]:
        """By (text, shard, item): item_id, best score, and the overlaps, of confirmed items."""
        found: dict[tuple[int, int, int], tuple[int, float, float, float]] = {}
        units: list[tuple[int, list[bytes]]] = []
        held = 0
        for at, text in enumerate(texts):
            before: list[bytes] = []
            for piece in pieces(text or b""):
                words = before + plain(piece)
                units.append((at, words))
                held += len(words)
                before = words[-self.overlap :]
                if held > 300_000:
                    self._units(units, found)
                    units, held = [], 0
        self._units(units, found)
        return found

    def _units(self, units: list[tuple[int, list[bytes]]], found: dict) -> None:
        units = [(at, words) for at, words in units if words]
        for number, shard in enumerate(self.shards) if units else ():
            for unit, half, block in self._open(shard, [words for _, words in units]):
                at, words = units[unit]
                passage = words[half * shard.half : (half + 3) * shard.half]
                known = {shard.vocabulary[w] for w in passage if w in shard.vocabulary}
                have = np.fromiter(known, np.int64, len(known))
                for item in range(block * shard.block, min((block + 1) * shard.block, len(shard.items))):
                    score = float(shard.impacts[item][np.isin(shard.terms[item], have)].sum())
                    if score >= self.settings.threshold - 1e-12:
                        item_id, question, answer = shard.items[item]
                        q, a = self._overlap(question, passage), self._overlap(answer, passage)
                        if min(q, a) >= self.settings.overlap:
                            old = found.get((at, number, item), (0, -1.0, 0.0, 0.0))
                            found[at, number, item] = max(old, (item_id, score, q, a), key=lambda x: x[1:])

    def _overlap(self, part: list[bytes], passage: list[bytes]) -> float:
        """The share of the part's runs of words that the passage has; 1 for an empty part."""
        n = min(self.settings.gram, len(part))
        if not n:
            return 1.0
        runs = {tuple(part[k : k + n]) for k in range(len(part) - n + 1)}
        return sum(r in runs for r in {tuple(passage[k : k + n]) for k in range(len(passage) - n + 1)}) / len(runs)

    def _open(self, shard: Shard, units: list[list[bytes]]) -> Iterator[tuple[int, int, int]]:
        """(unit, first half, block) where a passage's bounds reach the threshold."""
        none = len(shard.vocabulary)
        get = shard.vocabulary.get
        lengths = np.array([len(words) for words in units])
        terms = np.fromiter((get(w, none) for words in units for w in words), np.int64, int(lengths.sum()))
        # halves are numbered over all units
        per_unit = -(-lengths // shard.half)
        first = np.cumsum(per_unit) - per_unit
        place = np.arange(len(terms)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        half = np.repeat(first, lengths) + place // shard.half
        n_halves = int(per_unit.sum())
        unit_of = np.repeat(np.arange(len(units)), per_unit)
        known = terms < none
        pairs = np.unique(half[known] * none + terms[known])
        half, terms = pairs // none, pairs % none
        # of the words that aren't looked up, a passage's bound for all blocks alike
        base = np.bincount(half, shard.largest[terms], n_halves)
        total = np.zeros(n_halves)
        for shift in range(3):
            total[: n_halves - shift] += np.where(unit_of[: n_halves - shift] == unit_of[shift:], base[shift:], 0)
        rows, cols, values = self._postings(shard, half, terms)
        n_blocks = len(shard.rest)
        # a posting counts in the three passages that share its half; a word in two halves of one counts twice
        ok = [(rows >= shift) & (unit_of[rows] == unit_of[np.maximum(rows - shift, 0)]) for shift in range(3)]
        keys = np.concatenate([(rows[k] - shift) * n_blocks + cols[k] for shift, k in enumerate(ok)])
        if not len(keys):
            return
        keys, where = np.unique(keys, return_inverse=True)
        bound = np.bincount(where, np.concatenate([values[k] for k in ok]))
        start, block = keys // n_blocks, keys % n_blocks
        for at in np.flatnonzero(bound + np.minimum(total[start], shard.rest[block]) >= self.settings.threshold - 1e-9):
            unit = int(unit_of[start[at]])
            yield unit, int(start[at] - first[unit]), int(block[at])

    @staticmethod
    def _postings(shard: Shard, half: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = shard.starts[terms + 1] - shard.starts[terms]
        rows = np.repeat(half, counts)
        at = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(shard.starts[terms], counts)
        return rows, shard.blocks[at], shard.bounds[at]


def _passes(benchmark: DataFrame, settings: Settings, item_id: str, text: str) -> Iterator[list[Shard]]:
    """The index, a shard for each class of lengths, in broadcasts of about ``settings.words`` words (most often one, hence one
    pass over the documents); document frequencies and lengths are those of all items."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [question_and_answer(t) for t in batch.column(2).to_pylist()]
            parts = [pa.array([x[k] for x in both], pa.list_(pa.binary())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *parts], ["uid", "item_id", "question", "answer"])

    rows = benchmark.select(quoted(item_id).cast("bigint").alias("item_id"), quoted(text).alias("text")).where("text is not null").distinct()
    items = rows.select(F.monotonically_increasing_id().alias("uid"), "item_id", "text").mapInArrow(split, ITEM)
    items = staged(items.withColumn("n", F.size("question") + F.size("answer")).where("n > 0"), "items")
    whole = items.agg(F.count(F.lit(1)).alias("count"), F.avg("n").alias("mean")).first()
    if not whole["count"]:
        return
    words = items.select("uid", F.explode(F.array_distinct(F.concat("question", "answer"))).alias("word"))
    frequency = words.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weighed = words.join(frequency, "word").groupBy("uid").agg(F.collect_list(F.struct("word", "df")).alias("words"))
    # similar lengths together: up to 64 words, 128, 256, ...
    length = F.greatest(F.ceil(F.log2(F.col("n").cast("double"))), F.lit(6)).cast("int")
    index = staged(items.join(weighed, "uid").withColumn("class", length), "index")
    shards, held = [], 0
    for r in sorted(index.groupBy("class").agg(F.sum("n").alias("n")).collect(), key=lambda r: r["class"]):
        parts = -(-r["n"] // settings.words)
        for part in range(parts):
            here = index.where((F.col("class") == r["class"]) & (F.pmod(F.xxhash64("uid"), F.lit(parts)) == part)).collect()
            own = sum(row["n"] for row in here)
            if shards and held + own > settings.words:
                yield shards
                shards, held = [], 0
            if here:
                shards.append(_shard(here, whole["count"], whole["mean"], settings))
                held += own
    if shards:
        yield shards


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per row of ``docs`` and item that a passage of it contains: doc_id, item_id, score (of the best passage,
    1 if it has all the item's words), question_overlap, answer_overlap (shares of runs of words found there).

    Null and empty texts and items contain nothing and are contained nowhere. An item shorter than a run must be
    there whole. Repeated items (equal in id and text) count once, repeated rows of ``docs`` each; a null id is
    kept as null. Other columns are ignored; empty tables give an empty table.
    """
    spark = docs.sparkSession
    slim = docs.select(quoted(doc_id).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    found = [slim.mapInArrow(_hits(spark.sparkContext.broadcast(shards), settings), HIT) for shards in _passes(benchmark, settings, item_id, item_text)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], HIT)


def _hits(sent, settings: Settings):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Search(sent.value, settings)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(ids[at], *hit) for (at, _, _), hit in index.texts(utf8(batch.column(1))).items()]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return search


def keep_clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item."""
    for shards in _passes(benchmark, settings, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(shards)

        def chooser(sent=sent):
            index = _Search(sent.value, settings)

            def chosen(texts: list[bytes | None]) -> list[bool]:
                hit = {at for at, _, _ in index.texts(texts)}
                return [at not in hit for at in range(len(texts))]

            return chosen

        docs = chosen_by_text(docs, text, chooser)
    return docs
