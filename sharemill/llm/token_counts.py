"""Token counts by a map-side two-tier lookup.

A subword tokenizer that never joins pieces across white space gives a text as many tokens as its words have one
by one. The first tier is a broadcast table with the token counts of the commonest words; a worker encodes every
other word with the tokenizer itself and remembers it in a bounded cache, the second tier. Words never travel:
to find the common ones, every task sums up its own words in a bounded summary, and only summaries are merged.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharemill.llm.words import pieces, utf8

SUMMARY = "words array<binary>, counts array<bigint>"
OUT = "doc_id bigint, n_bytes bigint, n_tokens bigint"


@dataclass(frozen=True)
class Tiers:
    """Bounds: words in the broadcast table and in a task's summary, bytes of a word that either tier keeps
    (which together bound the broadcast: 2 MB), bytes of text after which a task drops longer words, entries of a worker's
    cache, summaries merged by one task."""

    table: int = 32_768
    longest: int = 64
    text: int = 1 << 26
    cache: int = 500_000
    fan_in: int = 32


def common_words(texts: DataFrame, tiers: Tiers) -> list[bytes]:
    """The commonest words over all rows of the one text column, at most ``tiers.table``, commonest first.

    Summaries keep the largest counts (a lossy count): a word can be missed only if it is rare in every task,
    which costs time and never changes a result.
    """
    keep, longest = tiers.table, tiers.longest

    def summary(counts: Counter) -> pa.RecordBatch:
        top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:keep]
        arrays = [pa.array([[w for w, _ in top]], pa.list_(pa.binary())), pa.array([[n for _, n in top]], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, ["words", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        read = 0
        for batch in batches:
            for text in utf8(batch.column(0)):
                for piece in pieces(text or b""):
                    counts.update(piece.split())
                    read += len(piece)
                    if len(counts) > 16 * keep or read > tiers.text:
                        # the longest words that a summary may hold bound its bytes, the text read since then the others'
                        counts = Counter(dict(Counter(short(counts)).most_common(8 * keep)))
                        read = 0
        yield summary(Counter(short(counts)))

    def short(counts: Counter) -> dict[bytes, int]:
        return {w: n for w, n in counts.items() if len(w) <= longest}

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for row in batch.to_pylist():
                counts.update(dict(zip(row["words"], row["counts"], strict=True)))
        yield summary(counts)

    found, parts = texts.mapInArrow(count, SUMMARY), max(1, texts.rdd.getNumPartitions())
    while parts > 1:
        parts = -(-parts // tiers.fan_in)
        found = found.repartition(parts).mapInArrow(merge, SUMMARY)
    rows = found.collect()  # one summary
    return [bytes(w) for row in rows for w in row["words"]][:keep]


def token_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", tiers: Tiers = Tiers()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, as the ``tokenizers`` library counts them for
    the tokenizer file without added special tokens; special strings inside texts count as its default has it.

    The tokenizer must not merge across ASCII white space (its normalizer and pre-tokenizer work within words).
    A null text counts as empty (no bytes, no tokens). Repeated rows are counted each; other columns are ignored.
    An empty table gives an empty table. Workers read the file at the same path.
    """
    from tokenizers import Tokenizer

    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    encoder = Tokenizer.from_file(tokenizer)
    common = [w for w in common_words(slim.select("text"), tiers) if _decodes(w)]
    lengths = [len(x.ids) for x in encoder.encode_batch([w.decode() for w in common], add_special_tokens=False)]
    first = docs.sparkSession.sparkContext.broadcast(dict(zip(common, lengths, strict=True)))
    cache_size, longest = tiers.cache, tiers.longest

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        lookup = _Lookup(first.value, Tokenizer.from_file(tokenizer), cache_size, longest)
        for batch in batches:
            texts = utf8(batch.column(1))
            tokens = [sum(sum(map(lookup.__getitem__, piece.split())) for piece in pieces(t or b"")) for t in texts]
            sizes = [len(t or b"") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    return slim.mapInArrow(count, OUT)


def _decodes(word: bytes) -> bool:
    try:
        word.decode()
    except UnicodeDecodeError:
        return False
    return True


class _Lookup(dict):
    """Word to token count: the common words, and others as they are met, dropped when there are too many."""

    def __init__(self, common: dict[bytes, int], encoder, size: int, longest: int) -> None:
        super().__init__(common)
        self.common, self.encoder, self.room, self.size, self.longest = len(common), encoder, size, size, longest

    def __missing__(self, word: bytes) -> int:
        n = len(self.encoder.encode(word.decode(errors="replace"), add_special_tokens=False).ids)
        if len(word) <= self.longest:
            if not self.room:
                for old in list(islice(self, self.common, None)):  # in order of arrival: the common ones stay
                    del self[old]
                self.room = self.size
            self[word] = n
            self.room -= 1
        return n
