"""A hidden Markov language model.

States emit symbols: the commonest words, each a symbol of its own, and classes of all other words by their ending.
A word of a class then has the class's add-one share of its count, so that every word of any vocabulary has a
probability, and the unknown words of a class share one. Every pass of Baum-Welch runs over all training text, the first
ones in parts, each of which makes the next model from the expected counts that tasks add up. A text is one chain, however
long; it is cut into pieces that advance side by side with the messages of the whole chain (see ``chains``). Texts are
scored exactly by the scaled forward recursion.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sharemill.llm.chains import Pieces
from sharemill.llm.splits import held_out
from sharemill.llm.tables import quoted, shared_path, staged
from sharemill.llm.words import portions, split_words

LOG10 = float(np.log(10.0))
#: Bytes of text whose words a task holds at once.
TEXT = 1 << 20


@dataclass(frozen=True)
class Settings:
    """States; words that are symbols; classes of other words; words whose count goes to every task (the other counts
    are joined), which with the next bound of bytes bounds the broadcast; longest such word; for each pass over all
    training text the number of parts (each a divisor of the first) after each of which the model is made anew; weight of
    the symbols' overall shares in a state's; elements of a piece of a text, and of all that a task works on at a time."""

    states: int = 8
    symbols: int = 16_384
    classes: int = 512
    counted: int = 131_072
    longest: int = 64
    passes: tuple[int, ...] = (8, 4, 1)
    weight: float = 500.0
    piece: int = 512
    room: int = 300_000

    @property
    def end(self) -> int:
        return self.symbols + self.classes


@dataclass(frozen=True)
class Lexicon:
    """Counts of the commonest words, commonest first, and what the classes hold besides the symbols."""

    counts: dict[bytes, int]
    tokens: int
    distinct: int
    class_tokens: np.ndarray
    class_words: np.ndarray


@dataclass(frozen=True)
class Model:
    start: np.ndarray
    step: np.ndarray
    emission: np.ndarray  # symbol by state


def word_class(word: bytes, classes: int) -> int:
    return zlib.crc32(word[-3:]) % classes


def word_classes(words: pa.Array, classes: int) -> np.ndarray:
    """The class of each word, found once for each ending."""
    endings = pc.binary_slice(words, -3).dictionary_encode()
    own = np.fromiter((word_class(w, classes) for w in endings.dictionary.to_pylist()), np.int64, len(endings.dictionary))
    return own[endings.indices.to_numpy()]


def word_counts(texts: DataFrame, room: int = 300_000, size: int = 1 << 26) -> DataFrame:
    """word, n over all rows of one text column; every task adds up its words before they are shuffled, until they are
    more than ``room`` or come from more than ``size`` bytes of text, however long they are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, read = [], 0
        for batch in batches:
            for part in portions(batch, 0, min(size, TEXT)):
                for _, found in split_words(part.column(0), min(size, TEXT)):
                    counts = found.value_counts()
                    held.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
                    read += pc.sum(pc.binary_length(found)).as_py() or 0
                    if read > size or sum(map(len, held)) > 3 * room // 2:
                        held = [added(held)]
                        if read > size or len(held[0]) > room:
                            yield from held[0].to_batches(50_000)
                            held, read = [], 0
        if held:
            yield from added(held).to_batches(50_000)
        held.clear()
        pa.default_memory_pool().release_unused()  # the worker goes on with other tasks

    def added(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    return texts.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame, n_texts: int, settings: Settings) -> Lexicon:
    """From the written table of counts and the number of training texts, each of which has one end."""
    short = counts.where(F.length("word") <= settings.longest).withColumn("bin", F.floor(64 * F.log2("n")).cast("int"))
    # the commonest words are those from some bin of counts on, so that they are at most ``counted``
    sizes, least, room = short.groupBy("bin").count().collect(), 1 << 20, settings.counted
    for r in sorted(sizes, key=lambda r: -r["bin"]):  # at most 64 rows for each power of two
        room -= r["count"]
        if room < 0:
            break
        least = r["bin"]
    common = short.where(F.col("bin") >= least).select("word", "n").toArrow()
    ranked = sorted(zip(common["word"].to_pylist(), common["n"].to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    top = dict(ranked)
    symbols, classes = list(top)[: settings.symbols], settings.classes
    sent = counts.sparkSession.sparkContext.broadcast(symbols)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, distinct, known = np.zeros(classes, np.int64), np.zeros(classes, np.int64), pa.array(sent.value, pa.binary())
        for batch in batches:
            word = batch.column(0).cast(pa.binary())
            other = pc.invert(pc.is_in(word, value_set=known))
            own = word_classes(word.filter(other), classes)
            np.add.at(tokens, own, batch.column(1).filter(other).to_numpy())
            distinct += np.bincount(own, minlength=classes)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes)), pa.array(tokens), pa.array(distinct)], ["class", "tokens", "words"])

    class_tokens, class_words = np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    by_class = counts.mapInArrow(classify, "class bigint, tokens bigint, words bigint").groupBy("class").agg(F.sum("tokens").alias("t"), F.sum("words").alias("w"))
    for r in by_class.collect():
        class_tokens[r["class"]], class_words[r["class"]] = r["t"], r["w"]
    whole = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).first()
    return Lexicon(top, (whole["n"] or 0) + n_texts, whole["words"] + (n_texts > 0), class_tokens, class_words)


def encoded(texts: DataFrame, lex: Lexicon, n_texts: int, settings: Settings) -> DataFrame:
    """From rows doc_id, held_out, text: doc_id, held_out, n_tokens, symbols (two bytes each), n_known, base (log10 of
    count + 1, summed over the words with a broadcast count and the end), inner (that of the words within classes,
    less the classes' totals), rare (other words, each with its number)."""
    sent = texts.sparkSession.sparkContext.broadcast(lex)
    schema = (
        "doc_id bigint, held_out boolean, n_tokens bigint, symbols binary, n_known bigint, base double, inner double, "
        "rare array<struct<word: binary, n: bigint>>"
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, top = sent.value, settings.symbols
        place, counts = {w: at for at, w in enumerate(held.counts)}, np.fromiter(held.counts.values(), float, len(held.counts))
        total = np.log10(held.class_tokens + held.class_words + 1.0)
        # of every word with a broadcast count: log10 of count + 1, its symbol, and its share in its class; the last row is for others
        sizes, symbol, inner = np.append(np.log10(counts + 1), 0.0), np.arange(len(counts) + 1), np.zeros(len(counts) + 1)
        own = word_classes(pa.array(list(place)[top:], pa.binary()), settings.classes)
        symbol[top:-1] = top + own
        inner[top:-1] = sizes[top:-1] - total[own]
        ends = np.log10(n_texts + 1.0)
        for batch in (part for whole in batches for part in portions(whole, 2, TEXT)):
            n, known, base, within = (np.zeros(batch.num_rows, kind) for kind in (np.int64, np.int64, float, float))
            parts, rare = [], []
            for rows, words in split_words(batch.column(2), TEXT):
                # every different word is looked up once
                words = words.dictionary_encode()
                different, code = words.dictionary, words.indices.to_numpy()
                at = np.fromiter((place.get(w, -1) for w in different.to_pylist()), np.int64, len(different))
                missing, own_symbol, own_inner = at < 0, symbol[at], inner[at]
                own = word_classes(different.filter(pa.array(missing)), settings.classes)
                own_symbol[missing], own_inner[missing] = top + own, -total[own]
                parts.append(own_symbol.astype(np.uint16)[code])
                n += np.bincount(rows, minlength=len(n))
                known += np.bincount(rows[~missing[code]], minlength=len(n))
                base += np.bincount(rows, sizes[at][code], len(n))
                within += np.bincount(rows, own_inner[code], len(n))
                # each row's words without a count, with their numbers
                rest, some = missing[code], max(1, len(different))
                pairs, times = np.unique(rows[rest] * some + code[rest], return_counts=True)
                row, word = np.divmod(pairs, some)
                rare.append(pa.table({"row": row, "word": different.take(pa.array(word)), "n": times.astype(np.int64)}))
            columns = [
                batch.column(0), batch.column(1), pa.array(n + 1), ended(n, parts, settings.end), pa.array(known + (n_texts > 0)),
                pa.array(base + ends), pa.array(within), lists(rare, batch.num_rows),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "symbols", "n_known", "base", "inner", "rare"])
        pa.default_memory_pool().release_unused()

    return texts.mapInArrow(encode, schema)


def ended(n: np.ndarray, parts: list[np.ndarray], end: int) -> pa.Array:
    """The symbols of texts of ``n`` words each, and an end after each text, two bytes a symbol."""
    stops = np.cumsum(n + 1)
    joined = np.full(int(n.sum()) + len(n), end, np.uint16)
    inside = np.ones(len(joined), bool)
    inside[stops - 1] = False
    joined[inside] = np.concatenate([np.zeros(0, np.uint16), *parts])
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, 2 * stops).astype(np.int32)), pa.py_buffer(joined)])


def lists(found: list[pa.Table], rows: int) -> pa.ListArray:
    """For each row its words with their numbers, from tables in the order of rows; long texts come in several."""
    if len(found) > 1:
        whole = pa.concat_tables(found).group_by(["row", "word"], use_threads=False).aggregate([("n", "sum")])
        found = [whole.rename_columns({"n_sum": "n"}).sort_by("row")]
    words, n, row = (found[0][c].combine_chunks() if found else pa.array([], kind) for c, kind in (("word", pa.binary()), ("n", pa.int64()), ("row", pa.int64())))
    offsets = np.append(0, np.cumsum(np.bincount(row.to_numpy(), minlength=rows))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([words, n], ["word", "n"]))


# -- Baum-Welch -------------------------------------------------------------------------------------------------


def first_model(settings: Settings, shares: np.ndarray) -> Model:
    """States that keep to themselves, each with the symbols' shares disturbed at random."""
    random, s = np.random.default_rng(11), settings.states
    emission = shares[:, None] * np.exp(0.5 * random.standard_normal((len(shares), s)))
    step = np.full((s, s), 0.1 / max(1, s - 1))
    np.fill_diagonal(step, 0.9)
    return Model(np.full(s, 1 / s), step / step.sum(axis=1, keepdims=True), emission / emission.sum(axis=0))


def _blocks(batches: Iterator[pa.RecordBatch], column: int, room: int) -> Iterator[list[np.ndarray]]:
    """The texts of a column of symbols, in lists of less than ``room`` symbols or of one text."""
    waiting: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for raw in batch.column(column):
            text = np.frombuffer(raw.as_buffer(), np.uint16)
            if waiting and held + len(text) >= room:
                yield waiting
                waiting, held = [], 0
            waiting.append(text)
            held += len(text)
    if waiting:
        yield waiting


def expected_counts(rows: DataFrame, model: Model, settings: Settings) -> np.ndarray:
    """Expected counts by state, over all rows: a row for each symbol, then for each state (transitions from it to
    the states), then one for the starts."""
    sent, s, symbols = rows.sparkSession.sparkContext.broadcast(model), settings.states, settings.end + 1
    names = [f"c{k}" for k in range(s)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, sums = sent.value, np.zeros((symbols + s + 1, s))
        emission, step, start = (np.maximum(x, 1e-30).astype(np.float32) for x in (m.emission, m.step, m.start))
        for texts in _blocks(batches, 0, settings.room):
            chains = Pieces(texts, emission.__getitem__, step, start, settings.piece, settings.room)
            for elements, likely in chains.smooth(sums[symbols : symbols + s], sums[-1], ordered=False):
                elements = elements.astype(np.intp)
                for k in range(s):
                    sums[:symbols, k] += np.bincount(elements, likely[:, k], symbols)
        at = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(sums[at, k]) for k in range(s))], ["symbol", *names])

    schema = ", ".join(["symbol bigint", *(f"{n} double" for n in names)])
    totals = rows.select("symbols").mapInArrow(count, schema).groupBy("symbol").agg(*[F.sum(n).alias(n) for n in names])
    out, found = np.zeros((symbols + s + 1, s)), totals.toArrow()  # a row per symbol and state
    out[found["symbol"].to_numpy()] = np.stack([found[n].to_numpy() for n in names], axis=1).reshape(-1, s)
    return out


def reestimated(counts: np.ndarray, shares: np.ndarray, settings: Settings) -> Model:
    symbols, s = settings.end + 1, settings.states
    seen = counts[:symbols] + settings.weight * shares[:, None]
    moves, start = counts[symbols : symbols + s] + 0.1, counts[-1] + 0.1
    return Model(start / start.sum(), moves / moves.sum(axis=1, keepdims=True), seen / seen.sum(axis=0))


def baum_welch(train: DataFrame, lex: Lexicon, n_texts: int, settings: Settings) -> Model:
    """The model of all training rows (encoded, with a column ``part`` from 0 to below the first number of parts). Every
    pass reads them all; a part without rows changes nothing."""
    counts = np.zeros(settings.end + 1)
    top = list(lex.counts.values())[: settings.symbols]
    counts[: len(top)] = top
    counts[settings.symbols : settings.end] = lex.class_tokens
    counts[settings.end] = n_texts
    shares = (counts + 0.5) / (counts + 0.5).sum()
    model = first_model(settings, shares)
    finest = settings.passes[0]
    for parts in settings.passes:
        for part in range(parts):
            own = train.where((F.col("part") >= part * finest // parts) & (F.col("part") < (part + 1) * finest // parts))
            found = expected_counts(own, model, settings)
            if found.any():
                model = reestimated(found * parts, shares, settings)
    return model


# -- scoring ----------------------------------------------------------------------------------------------------


def log_likelihoods(texts: list[np.ndarray], model: Model, settings: Settings) -> np.ndarray:
    """The log10 likelihood of each text (array of symbols), exactly."""
    return Pieces(texts, model.emission.__getitem__, model.step, model.start, settings.piece, settings.room).log_likelihoods() / LOG10


def language_scores(docs: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out (crc32 of the id as text leaves 2 when divided by 7), n_tokens
    (words and one end), n_known, train_tokens, base_score and score (log10 probabilities of the text).

    Learns from all rows that aren't held out. Null and empty texts are an end alone, also in training; a null id
    isn't held out. Repeated rows are learned from and scored each. Other columns are ignored; an empty table gives
    an empty table, and with all rows held out every word is unknown.
    """
    spark = docs.sparkSession
    slim = docs.select(quoted(doc_id).cast("bigint").alias("doc_id"), quoted(text).alias("text"))
    slim = slim.select("doc_id", held_out(F.col("doc_id"), 7, 2).alias("held_out"), "text")
    train = slim.where("not held_out")
    n_texts = train.count()
    counts = staged(word_counts(train.select("text")), "word-counts")
    lex = lexicon(counts, n_texts, settings)
    marked = encoded(slim, lex, n_texts, settings).withColumn("row", F.monotonically_increasing_id())
    part = F.pmod(F.xxhash64("row"), F.lit(settings.passes[0])).cast("int")
    path = shared_path(spark, "encoded")
    marked.withColumn("part", part).write.partitionBy("part").parquet(path)  # a part is read alone
    written = spark.read.schema(StructType([*marked.schema.fields, StructField("part", IntegerType())])).parquet(path)
    rows = written.drop("part")
    model = baum_welch(written.where("not held_out").select("symbols", "part"), lex, n_texts, settings)
    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [log_likelihoods(texts, sent.value, settings) for texts in _blocks(iter([batch]), 1, settings.room)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found))], ["row", "forward"])

    # words without a broadcast count meet theirs; each text gets back sums alone
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.n").alias("times"))
    sums = (
        rare.join(counts, "word", "left").groupBy("row")
        .agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("rare_sum"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    )
    forward = rows.select("row", "symbols").mapInArrow(score, "row bigint, forward double")
    norm = float(np.log10(lex.tokens + lex.distinct + 1.0))
    rest = F.coalesce("rare_sum", F.lit(0.0))
    return (
        rows.drop("symbols", "rare").join(forward, "row").join(sums, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
            F.lit(lex.tokens).cast("bigint").alias("train_tokens"), (F.col("base") + rest - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
            (F.col("forward") + F.col("inner") + rest).alias("score"),
        )
    )
