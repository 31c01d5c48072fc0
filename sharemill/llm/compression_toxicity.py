"""Toxicity by compression distance.

One zstandard dictionary is trained, on windows of both classes without words that tell them apart. It is the shared
part of two dictionaries, a toxic and an ordinary one, whose class parts aren't trained: each is a list of words and
beginnings of words that a statistical test finds more often in its class. A window of text that shrinks more with the
toxic dictionary than with the ordinary one looks toxic. The margins of a document's windows become a score by a
logistic fit, whose 0.5 is the calibrated threshold. Two dictionaries trained apart, one on each class, tell the
classes worse (figures in the README).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sharemill.llm.splits import held_out
from sharemill.llm.words import pieces, utf8

CLEAR = (1, 2, 3, 4, 5, 7)
FEATURES = 4 + len(CLEAR)
#: Fixed value: the repeat offsets 1, 4 and 8, with which the header of a trained zstandard dictionary ends.
_REPEATS = b"\x01\x00\x00\x00\x04\x00\x00\x00\x08\x00\x00\x00"
_EDGES = b".,;:!?%$&*#|\"'()<>[]{}=+-_/\\"


@dataclass(frozen=True)
class Fit:
    """Bounds of the labelled sample, per class: documents (those with the smallest hashes of their id) and windows
    of them (likewise); bytes of a window, of the shared part of a dictionary, and of its class part at least and at most; when a beginning of words tells the classes apart (in
    standard errors of the difference of its shares of documents, as a ratio of them, and against the most telling one)."""

    documents: int = 4000
    windows: int = 60_000
    window: int = 100
    shared: int = 6400
    own: int = 600
    most: int = 65_536
    errors: float = 6.0
    ratio: float = 3.0
    strongest: float = 0.25


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    window: int
    means: np.ndarray
    scales: np.ndarray
    weights: np.ndarray
    prior: float


def windows(text: bytes | None, size: int) -> Iterator[bytes]:
    """Pieces of about ``size`` bytes, cut at white space, A-Z in lower case; very long words are cut up."""
    for piece in pieces(text or b"", size):
        plain = b" ".join(piece.lower().split())
        for start in range(0, len(plain), 4 * size):
            yield plain[start : start + 4 * size]


class _Margins:
    """Bytes that the toxic dictionary saves over the ordinary one, by window."""

    def __init__(self, toxic: bytes, ordinary: bytes, size: int) -> None:
        self.toxic, self.ordinary, self.size = _compressor(toxic), _compressor(ordinary), size

    def features(self, text: bytes | None) -> list[float]:
        """Of all windows: the mean margin, the largest, the sum of the three largest, and the logarithms of the
        number of windows and of those that reach the margins ``CLEAR``."""
        toxic, ordinary = self.toxic.compress, self.ordinary.compress
        found = [len(ordinary(x)) - len(toxic(x)) for x in windows(text, self.size)]
        if not found:
            return [0.0] * FEATURES
        top = sorted(found, reverse=True)[:3]
        return [sum(found) / len(found), float(top[0]), float(sum(top)), math.log1p(len(found))] + [
            math.log1p(sum(x >= margin for x in found)) for margin in CLEAR
        ]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    """A fast greedy search that takes matches from four bytes on: short stems count, and it finds them all."""
    kind = zstandard.ZstdCompressionDict(content or b"\n" * 8, dict_type=zstandard.DICT_TYPE_AUTO)
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=14, chain_log=14, search_log=3, min_match=4, target_length=16, strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False, write_dict_id=False,
    )
    kind.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=kind)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", fit: Fit = Fit()) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out (crc32 of the id as text is a multiple of 5), score (0 to 1),
    predicted (1 from 0.5 on).

    Learns from labelled rows that aren't held out. Labels that are null or for null ids don't count; of repeated
    labels of a document the highest counts. Without rows of both classes to learn from, every score is the share of
    toxic labels (0 without any). Null and empty texts score like a text without any margin; a null id isn't held
    out. Repeated rows score alike, other columns are ignored, an empty table gives an empty table.
    """
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    model = fitted(slim, labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("toxic")), fit)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        margins = _Margins(m.toxic, m.ordinary, m.window)
        for batch in batches:
            x = np.array([margins.features(t) for t in utf8(batch.column(1))], dtype=float).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_probability(m, x))], ["doc_id", "score"])

    return slim.mapInArrow(score, "doc_id bigint, score double").select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def fitted(docs: DataFrame, labels: DataFrame, fit: Fit) -> Model:
    """The dictionaries and the calibration, from the bounded sample."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"), 5, 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    empty = Model(b"", b"", fit.window, np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), share)
    if len(sizes) < 2:
        return empty
    chosen = reduce(DataFrame.unionByName, [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit.documents) for c in (0, 1)])
    # at most two times ``fit.documents`` ids and labels
    sample = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    size, most = fit.window, 4 * fit.window

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, toxic, t in zip(ids, marks, utf8(batch.column(2)), strict=True):
                found = list(windows(t, size))
                for start in range(0, len(found), 4096):
                    part = found[start : start + 4096]
                    own = [pa.array([doc] * len(part), pa.int64()), pa.array([toxic] * len(part), pa.int32()), pa.array(part, pa.binary())]
                    yield pa.RecordBatch.from_arrays(own, ["doc_id", "toxic", "window"])

    cuts = sample.mapInArrow(cut, "doc_id bigint, toxic int, window binary").where(F.length("window") <= most)
    taken = [cuts.where(F.col("toxic") == c).orderBy(F.xxhash64("window"), "window").limit(fit.windows) for c in (0, 1)]
    ordinary, toxic = {}, {}
    for found, part in ((ordinary, taken[0]), (toxic, taken[1])):
        for r in part.select("doc_id", "window").collect():
            found.setdefault(r["doc_id"], []).append(bytes(r["window"]))
    if not toxic or not ordinary:
        return empty
    dictionaries = _dictionaries(toxic, ordinary, fit)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins = _Margins(*dictionaries, size)
        for batch in batches:
            x = [margins.features(t) for t in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["toxic", "x"])

    rows = sample.mapInArrow(measure, "toxic int, x array<double>").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float)
    taken_of = {c: max(1.0, float((y == c).sum())) for c in (0, 1)}
    weight = np.where(y == 1, sizes[1] / taken_of[1], sizes[0] / taken_of[0])  # back to the classes' shares
    means, scales = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(*dictionaries, fit.window, means, scales, *_logistic((x - means) / scales, y, weight))


def _dictionaries(toxic: dict[int, list[bytes]], ordinary: dict[int, list[bytes]], fit: Fit) -> tuple[bytes, bytes]:
    """Dictionary contents from the windows by document: what both classes share, then (where references are
    cheapest) what is each one's own. Both have the same layout, so that margins come from what differs alone."""
    # a document counts once, however often it repeats a word, and copies of a document count once
    bags = [list({frozenset(w for x in found for w in _plain(x)) for found in sample.values()}) for sample in (toxic, ordinary)]
    counts, sizes = [Counter(stem for bag in x for stem in {s for w in bag for s in _stems(w)}) for x in bags], [len(x) for x in bags]
    own, telling = [], set()
    for mine, other in ((0, 1), (1, 0)):
        strength = {}
        for stem, n in counts[mine].items():
            p, q = n / sizes[mine], counts[other][stem] / sizes[other]
            both = (n + counts[other][stem]) / sum(sizes)
            error = np.sqrt(both * (1 - both) * (1 / sizes[0] + 1 / sizes[1])) + 1e-12
            if p > fit.ratio * q and p - q > fit.errors * error:
                strength[stem] = (p - q) / error
        least = fit.strongest * max(strength.values(), default=0.0)
        strength = {s: x for s, x in strength.items() if x >= least}
        # of the stems of a word the most telling one, of equals the longest
        words = {w for bag in bags[mine] for w in bag}
        chosen = {max((s for s in _stems(w) if s in strength), key=lambda s: (strength[s], len(s)), default=None) for w in words} - {None}
        telling |= chosen
        # the most telling come last, where references to them are cheapest
        own.append(b" ".join(sorted(chosen, key=lambda s: (strength[s], s)))[-fit.most :])
    # what is shared must tell nothing, else it would be in both dictionaries
    neutral = [x for sample in (ordinary, toxic) for found in sample.values() for x in found if not any(s in telling for w in _plain(x) for s in _stems(w))]
    header, shared = _trained(neutral, fit.shared)
    room = max(fit.own, *map(len, own))
    filler = _trained(neutral[::2], room)[1]
    return tuple(header + shared + (filler[: max(0, room - len(x))] + b" " + x + b" ").rjust(room + 2) for x in own)


def _stems(word: bytes) -> set[bytes]:
    """The beginnings of a word, and the word. Shorter words are matched with the blanks around them."""
    return {word[:n] for n in range(4, min(9, len(word) + 1))} | ({word} if word else set())


def _plain(window: bytes) -> list[bytes]:
    return [w.strip(_EDGES) for w in window.split()]


def _trained(samples: list[bytes], size: int) -> tuple[bytes, bytes]:
    """Header (symbol statistics) and content of a dictionary trained on the samples; where they are too few or too
    alike to train on, no header and the samples themselves."""
    try:
        # the header takes up to 256 bytes of a dictionary
        header, mark, content = zstandard.train_dictionary(size + 256, samples).as_bytes().partition(_REPEATS)
    except zstandard.ZstdError:
        return b"", b" ".join(dict.fromkeys(samples))[-size:]
    return header + mark, content[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights, and the score of an all-average document in place of the intercept (Newton's method)."""
    z = np.hstack([x, np.ones((len(x), 1))])
    b = np.zeros(z.shape[1])
    penalty = ridge * np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = _sigmoid(z @ b)
        step = np.linalg.solve((z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + penalty, z.T @ (weight * (y - p)) - penalty @ b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return b[:-1], float(_sigmoid(b[-1]))


def _sigmoid(v):
    return 1 / (1 + np.exp(-np.clip(v, -500, 500)))


def _probability(m: Model, x: np.ndarray) -> np.ndarray:
    prior = min(max(m.prior, 1e-12), 1 - 1e-12) if m.weights.any() else m.prior
    if not m.weights.any():
        return np.full(len(x), prior)
    return _sigmoid((x - m.means) / m.scales @ m.weights + np.log(prior / (1 - prior)))
