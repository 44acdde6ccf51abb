"""Word hashes of whole Arrow text columns, in numpy: no Python object per word.

Words are the runs between separator bytes; in the default table these are the white space
bytes 0x20 and 0x09 to 0x0D, so a word is ``[^\\x20\\x09-\\x0D]+``. A null text is an empty text.
Hashes have 64 bits; two different words share one with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once; a longer document is a chunk of its own.
CHUNK_BYTES = 2 << 20

_rng = np.random.default_rng(20240117)
_BYTES = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Words(NamedTuple):
    """Hashes of the words of some documents; document d has words[first[d]:first[d + 1]]."""

    words: np.ndarray
    first: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finisher: every bit of the input reaches every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows in them."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32,
                            len(column) + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text each, or of one row."""
    if len(column) == 0:
        return
    _, offsets = text_buffer(column)
    start = 0
    while start < len(column):
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = max(start + 1, min(end, len(column)))
        yield start, end
        start = end


def word_spans(data: np.ndarray, offsets: np.ndarray,
               separators: np.ndarray = WHITE_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in ``data``, and the first word of each document."""
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each non-empty span of ``data``, the same wherever the span stands."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    heads = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(heads, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE))
    values = _BYTES[data[np.repeat(starts, lengths) + place]] * powers[place]
    return mixed(np.add.reduceat(values, heads) + lengths.astype(np.uint64))


def hashed_words(column: pa.Array, separators: np.ndarray = WHITE_SPACE) -> Words:
    """Hashes of all words of a chunk of a text column."""
    data, offsets = text_buffer(column)
    starts, ends, first = word_spans(data, offsets, separators)
    return Words(span_hashes(data, starts, ends), first)


def window_hashes(words: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """One hash per window start of the words at the given places of the window.

    Windows may run over the end of a document; the caller leaves those out.
    """
    count = len(words) - places[-1]
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, np.uint64(len(places)))
    for rank, place in enumerate(places):
        total += words[place:place + count] * _PLACES[rank]
    return mixed(total)


def shingles(words: Words, size: int) -> Words:
    """Hashes of all ``size``-word windows of each document, in order.

    A document of fewer words has one shingle, of all its words; one without words has none.
    """
    counts = np.diff(words.first)
    amounts = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    first = np.concatenate(([0], np.cumsum(amounts)))
    out = np.zeros(int(first[-1]), np.uint64)
    windows = window_hashes(words.words, tuple(range(size)))
    long = np.flatnonzero(counts >= size)
    place = np.arange(int(amounts[long].sum())) - np.repeat(
        np.cumsum(amounts[long]) - amounts[long], amounts[long])
    out[np.repeat(first[long], amounts[long]) + place] = windows[
        np.repeat(words.first[long], amounts[long]) + place]
    for document in np.flatnonzero((counts > 0) & (counts < size)):
        start, end = words.first[document], words.first[document + 1]
        out[first[document]] = window_hashes(words.words[start:end], tuple(range(end - start)))[0]
    return Words(out, first)
