"""Language identification by a linear-chain conditional random field over words.

A word's features are the byte n-grams of the word between two marks (those with a mark are its affixes) and the
word itself (the lexicon), hashed into a fixed number of buckets; transitions between the labels of neighbouring
words are learned with them. Forward-backward gives each word's probabilities in its context, which label
code-switched text word by word; their mean over a document names its language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharemill.llm.chains import Chains, Pieces
from sharemill.llm.splits import held_out
from sharemill.llm.tables import chosen_by_text
from sharemill.llm.words import pieces, utf8

UNDETERMINED = "und"
BITS = 16
#: Words of a piece of a chain; words handled at once; words that a worker remembers, and their bytes.
PIECE, FLUSH, CACHE, BYTES = 256, 300_000, 400_000, 1 << 25
#: Bytes of a training word that are kept.
LONGEST = 256


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample: about so many documents per language (those with the smallest hashes of their
    id), from each so many runs of so many words (those with the smallest hashes); steps of the optimizer; how
    many training chains of two runs join two languages."""

    documents: int = 500
    runs: int = 4
    words: int = 16
    steps: int = 60
    mixed: float = 0.25


@dataclass(frozen=True)
class Model:
    labels: list[str]
    weights: np.ndarray  # bucket by label
    transitions: np.ndarray  # label by next label


# -- features ---------------------------------------------------------------------------------------------------


def plain(word: bytes) -> bytes:
    """The word in lower case from its first to its last letter; empty if it has none."""
    text = word.decode(errors="replace").lower()
    letters = [at for at, c in enumerate(text) if c.isalpha()]
    return text[letters[0] : letters[-1] + 1].encode() if letters else b""


def _features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bucket) of every feature, and each word's scale."""
    marked = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    found, buckets = [], []
    factor, spread, shift = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BITS)
    gram = np.zeros(0, np.uint64)
    for n in range(1, 5):
        gram = marked + np.uint64(1) if n == 1 else gram[:-1] * factor + marked[n - 1 :] + np.uint64(1)
        inside = owner[: len(gram)] == owner[n - 1 :] if n > 1 else np.ones(len(gram), bool)
        found.append(owner[: len(gram)][inside])
        buckets.append(((gram[inside] * spread + np.uint64(n)) * spread >> shift).astype(np.int32))
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(marked), dtype=np.uint64) - np.repeat(starts, lengths).astype(np.uint64)
    mixed = (marked + place * spread) * spread
    whole = np.add.reduceat((mixed ^ (mixed >> np.uint64(29))) * spread, starts)
    found.append(np.arange(len(words), dtype=np.int32))
    buckets.append((whole * spread >> shift).astype(np.int32))
    return np.concatenate(found), np.concatenate(buckets), 1 / np.sqrt(4.0 * lengths)


def _emissions(words: list[bytes], weights: np.ndarray) -> np.ndarray:
    if not words:
        return np.zeros((0, weights.shape[1]), np.float32)
    owner, bucket, scale = _features(words)
    sums = [np.bincount(owner, weights[bucket, label], len(words)) * scale for label in range(weights.shape[1])]
    return np.stack(sums, axis=1).astype(np.float32)


# -- chains -----------------------------------------------------------------------------------------------------


def probabilities(table: np.ndarray, words: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's label probabilities, and the expected number of each transition; ``words`` holds the rows of
    ``table`` for the words of all chains, one chain after the other."""
    chains = Chains(lengths)
    local = np.exp(table - table.max(axis=1, keepdims=True))[chains.by_time(words)]
    likely, expected, _, _ = chains.smooth(local, np.exp(transitions).astype(local.dtype), np.ones(local.shape[1], local.dtype))
    return likely[chains.place], expected


# -- training ---------------------------------------------------------------------------------------------------


def fitted(docs: DataFrame, text: str, lang: str, doc_id: str, fit: Fit = Fit()) -> Model:
    """The model of the rows that aren't held out and have a language; no labels if there are none."""
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    ).where("lang is not null and text is not null")
    rows = rows.where(~held_out(F.col("doc_id"), 5, 0))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    labels = sorted(sizes)
    if not labels:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros((0, 0)))
    # a hash below its language's threshold: about ``fit.documents`` rows each
    share = F.create_map(*[F.lit(x) for name in labels for x in (name, min(1.0, fit.documents / sizes[name]))])
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = rows.where(hashed < F.element_at(share, F.col("lang")))
    runs, size = fit.runs, fit.words

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, ids, kept = batch.column(2).to_pylist(), batch.column(0).to_pylist(), []
            for doc, name, t in zip(ids, langs, utf8(batch.column(1)), strict=True):
                words = [p for piece in pieces(t) for p in map(plain, piece.split()) if p]
                parts = [words[at : at + size] for at in range(0, len(words), size)]
                picked = np.random.default_rng(abs(doc or 0)).permutation(len(parts))[:runs]
                kept += [(name, b" ".join(w[:LONGEST] for w in parts[at])) for at in sorted(picked)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.string()), pa.array([r for _, r in kept], pa.binary())], ["lang", "run"])

    sample = sorted((labels.index(r["lang"]), bytes(r["run"])) for r in chosen.mapInArrow(cut, "lang string, run binary").collect())
    return _train(labels, sample, fit)


def _train(labels: list[str], sample: list[tuple[int, bytes]], fit: Fit) -> Model:
    """Maximum likelihood with a light ridge, by Adam over all chains at once."""
    n = len(labels)
    if not sample or n == 1:
        return Model(labels, np.zeros((1 << BITS, n), np.float32), np.zeros((n, n)))
    random = np.random.default_rng(0)
    by_label = [[r.split() for k, r in sample if k == label] for label in range(n)]
    present = [k for k in range(n) if by_label[k]]
    chains, marks = [], []
    # languages count alike: each gives as many chains, drawn again where it has fewer runs
    for label in present:
        for _ in range(min(fit.documents * fit.runs, max(map(len, by_label))) // 2):
            other = int(random.choice(present)) if random.random() < fit.mixed else label
            one, two = (by_label[k][random.integers(len(by_label[k]))] for k in (label, other))
            chains.append(one + two)
            marks.append([label] * len(one) + [other] * len(two))
    if not chains:
        return Model(labels, np.zeros((1 << BITS, n), np.float32), np.zeros((n, n)))
    known = {w: at for at, w in enumerate(dict.fromkeys(w for chain in chains for w in chain))}
    words = np.fromiter((known[w] for chain in chains for w in chain), np.int64)
    gold = np.eye(n, dtype=np.float32)[np.concatenate([np.array(m) for m in marks])]
    lengths = np.array([len(c) for c in chains])
    inner = np.ones(len(words), bool)
    inner[np.cumsum(lengths) - 1] = False
    moves = gold[:-1][inner[:-1]].T @ gold[1:][inner[:-1]]
    owner, bucket, scale = _features(list(known))
    weights, transitions = np.zeros((1 << BITS, n), np.float32), np.zeros((n, n))
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, transitions)]
    for step in range(1, fit.steps + 1):
        local = np.stack([np.bincount(owner, weights[bucket, k], len(known)) * scale for k in range(n)], axis=1)
        likely, expected = probabilities(local.astype(np.float32), words, lengths, transitions)
        miss = gold - likely
        by_word = np.stack([np.bincount(words, miss[:, k], len(known)) for k in range(n)], axis=1) * scale[:, None]
        up = np.stack([np.bincount(bucket, by_word[owner, k], 1 << BITS) for k in range(n)], axis=1) / len(words)
        for value, slope, (first, second) in (
            (weights, up - 1e-7 * weights, state[0]), (transitions, (moves - expected) / len(words) - 1e-4 * transitions, state[1]),
        ):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            value += 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(labels, weights.astype(np.float32), transitions)


# -- labelling --------------------------------------------------------------------------------------------------


class _Ids(dict):
    """Raw word to row of the emission table; 0 for words without a letter, which have no place in a chain."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []
        self.size, self.bytes = 1, 0

    def __missing__(self, word: bytes) -> int:
        clean = plain(word)
        at = 0
        self.bytes += len(word)
        if clean:
            at = self.size
            self.size += 1
            self.new.append(clean)
        self[word] = at
        return at


class Tagger:
    """Labels the words of texts; keeps emissions of words it has met, in bounded tables."""

    def __init__(self, model: Model) -> None:
        self.model, self.n = model, max(1, len(model.labels))
        self._forget()

    def _forget(self) -> None:
        self.ids, self.table = _Ids(), np.ones((1, self.n), np.float32)

    def _emissions(self, ids: list[np.ndarray]) -> np.ndarray:
        """Label likelihoods, up to a factor, of the words of several runs."""
        new, self.ids.new = self.ids.new, []
        if new:
            fresh = _emissions(new, self.model.weights)
            self.table = np.concatenate([self.table, np.exp(fresh - fresh.max(axis=1, keepdims=True))])
        return self.table[np.concatenate(ids)]

    def words(self, texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(text number, numbers of its words that have a letter, their label probabilities), maybe in several parts for a
        text, in order. A text is one chain, however long."""
        owners: list[tuple[int, np.ndarray]] = []
        ids: list[np.ndarray] = []
        local: list[np.ndarray] = []
        held = 0
        for at, text in enumerate(texts):
            before = 0
            for piece in pieces(text or b""):
                raw = piece.split()
                own = np.fromiter(map(self.ids.__getitem__, raw), np.int64, len(raw))
                place = np.flatnonzero(own)
                if len(place):
                    owners.append((at, place + before))
                    ids.append(own[place])
                    held += len(place)
                before += len(raw)
                if len(self.ids) > CACHE or self.ids.bytes > BYTES:
                    if ids:
                        local.append(self._emissions(ids))
                        ids = []
                    self._forget()
            if held >= FLUSH:
                yield from self._labelled(owners, [*local, self._emissions(ids)] if ids else local)
                owners, ids, local, held = [], [], [], 0
        if owners:
            yield from self._labelled(owners, [*local, self._emissions(ids)] if ids else local)

    def _labelled(self, owners: list[tuple[int, np.ndarray]], local: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        likelihoods = np.concatenate(local)
        ends = np.cumsum([len(place) for _, place in owners])
        texts = np.array([at for at, _ in owners])
        # the parts of a text follow each other: they are one chain
        last = ends[np.r_[texts[1:] != texts[:-1], True]]
        chains = [np.arange(a, b) for a, b in zip(np.r_[0, last[:-1]], last, strict=True)]
        step, start = np.exp(self.model.transitions).astype(likelihoods.dtype), np.ones(self.n, likelihoods.dtype)
        smoothed = Pieces(chains, likelihoods.__getitem__, step, start, PIECE, FLUSH).smooth(np.zeros_like(step, float), np.zeros(self.n))
        likely = np.concatenate([found for _, found in smoothed])
        for (at, place), end in zip(owners, ends, strict=True):
            yield at, place, likely[end - len(place) : end]

    def documents(self, texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        sums, counts = np.zeros((len(texts), self.n)), np.zeros(len(texts))
        for at, place, likely in self.words(texts):
            sums[at] += likely.sum(axis=0, dtype=np.float64)
            counts[at] += len(place)
        best = sums.argmax(axis=1)
        known = (counts > 0) & bool(self.model.labels)
        score = np.where(known, sums[np.arange(len(texts)), best] / np.maximum(counts, 1), 0.0)
        names = [self.model.labels[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
        return names, np.clip(score, 0.0, 1.0).tolist()


def languages(docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit: Fit = Fit()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred (a learned language, or ``und``), score (the mean
    probability of that language over the words; 0 for ``und``).

    A text that is null, empty or without a letter is ``und``, and so is every text if there is nothing to learn
    from. Ties go to the language that sorts first. Rows with a null language are predicted, not learned from; a
    null id isn't held out. Repeated rows are predicted alike, other columns are ignored, an empty table gives an
    empty table.
    """
    model = model or fitted(docs, text, lang, doc_id, fit)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value)
        for batch in batches:
            names, score = tagger.documents(utf8(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = slim.mapInArrow(predict, "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score")


def word_languages(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of words of one language: doc_id, first and last (numbers of white-space separated words, from 0), lang.

    Words without a letter belong to no run of their own and don't end one; texts without letters give no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(sent.value)
        for batch in batches:
            ids, found = batch.column(0).to_pylist(), []
            for at, place, likely in tagger.words(utf8(batch.column(1))) if tagger.model.labels else ():
                label = likely.argmax(axis=1)
                starts = np.flatnonzero(np.r_[True, label[1:] != label[:-1]])
                ends = np.r_[starts[1:] - 1, len(label) - 1]
                found += [(ids[at], int(place[a]), int(place[b]), tagger.model.labels[label[a]]) for a, b in zip(starts, ends, strict=True)]
            columns = list(zip(*found, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "first", "last", "lang"])

    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(runs, "doc_id bigint, first bigint, last bigint, lang string")


def keep_identified(docs: DataFrame, model: Model | None = None, least: float = 0.34, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fit: Fit = Fit()) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is determined with a score of at least ``least``.

    Texts that are null, empty or without a letter go; so do texts whose words don't agree on a language.
    """
    model = model or fitted(docs, text, lang, doc_id, fit)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def chooser():
        tagger = Tagger(sent.value)
        return lambda texts: [n != UNDETERMINED and s >= least for n, s in zip(*tagger.documents(texts), strict=True)]

    return chosen_by_text(docs, text, chooser)
