"""Words of whole texts as bytes, in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are cut at white space into pieces of about this many bytes, so that memory doesn't grow with a text.
PIECE = 1 << 20
_SPACE = (32, 9, 10, 11, 12, 13)


def binary(column: pa.Array) -> pa.Array:
    """The texts of an Arrow column as UTF-8, without decoding or copying them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8, without decoding them."""
    return binary(column).to_pylist()


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """The text cut at ASCII white space; a word longer than ``size`` stays whole."""
    if len(text) <= size:
        yield text
        return
    start = 0
    while start < len(text):
        end = min(start + size, len(text))
        while end < len(text) and text[end] not in _SPACE:
            end += 1
        yield text[start:end]
        start = end


def words(text: bytes | None) -> Iterator[list[bytes]]:
    """Lists of the words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, piece by piece."""
    for piece in pieces(text or b""):
        yield piece.lower().split()


def portions(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """A batch some rows at a time, with about ``size`` bytes of a column's texts, or one long text and such a rest."""
    lengths = pc.fill_null(pc.binary_length(binary(batch.column(column))), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), batch.num_rows]
    return (batch.slice(start, end - start) for start, end in pairwise(cuts))


def split_words(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """The words of a column's texts, in order and as in ``words``: the row of each, and the words. Longer texts than
    ``size`` come in pieces of about that, each alone."""
    raw = binary(column)
    lengths = pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False)
    start = 0
    for at in [*np.flatnonzero(lengths > size).tolist(), len(raw)]:
        if at > start:
            rows, found = _split(raw.slice(start, at - start))
            yield rows + start, found
        for piece in pieces(raw[at].as_py(), size) if at < len(raw) else ():
            rows, found = _split(pa.array([piece], pa.binary()))
            yield rows + at, found
        start = at + 1


def _split(raw: pa.Array) -> tuple[np.ndarray, pa.Array]:
    text = raw.view(pa.large_string() if pa.types.is_large_binary(raw.type) else pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    found, rows = binary(pc.list_flatten(lists)).cast(pa.binary()), pc.list_parent_indices(lists)
    some = pc.not_equal(pc.binary_length(found), 0)  # none at the ends
    return rows.filter(some).to_numpy().astype(np.int64), found.filter(some)
