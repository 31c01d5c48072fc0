"""Sets of word shingles as sorted 64-bit hashes, computed for whole batches of texts at once.

Two different shingles of one comparison share a hash with a probability of about 2**-64; sets are otherwise exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from sharemill.llm.words import pieces

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SYMBOLS = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A-Z count as a-z.
_SYMBOLS[65:91] = _SYMBOLS[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Bytes hashed at once; texts are joined up to it, and cut (at white space) beyond it.
_SLICE = 1 << 20
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of the SplitMix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, _SLICE + 4096)
        for at, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, factor)
            steps[0] = 1
            _powers[at] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    raw = np.frombuffer(text, np.uint8)
    solid = ~_IS_SPACE[raw]
    starts = np.flatnonzero(solid & np.r_[True, ~solid[:-1]]) if len(raw) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    power, inverse = _power(len(raw))
    terms = np.where(solid, _SYMBOLS[raw] * power, np.uint64(0))
    return mix(np.add.reduceat(terms, starts) * inverse[starts]), starts


def _by_text(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The word hashes of each text."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < _SLICE):
            size += len(texts[end]) + 1
            end += 1
        if end == at + 1:
            yield np.concatenate([word_hashes(p)[0] for p in pieces(texts[at], _SLICE)] or [np.zeros(0, np.uint64)])
        else:
            hashes, starts = word_hashes(b" ".join(texts[at:end]))
            bounds = np.cumsum([0] + [len(t) + 1 for t in texts[at:end]])
            cuts = np.searchsorted(starts, bounds)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield hashes[a:b]
        at = end


def shingle_sets(texts: list[bytes | None], size: int) -> Iterator[np.ndarray]:
    """The distinct shingles of ``size`` words of each text, as sorted hashes.

    A text with fewer words has one shingle, the whole sequence; a text without words (or null) has none.
    """
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * _BASE) | np.uint64(1)
    for words in _by_text([t or b"" for t in texts]):
        if not len(words):
            yield words
            continue
        n = min(size, len(words))
        sums = sum(words[k : len(words) - n + 1 + k] * factors[k] for k in range(n))
        yield np.unique(mix(sums + np.uint64(n)))
