"""Benchmark decontamination by spaced seeds: overlaps that survive substituted words.

Tokens are lower-case runs without white space and ASCII punctuation. A mask looks at some
places of a window and ignores the others, so a window is still found if the ignored places
were changed. The windows of the test items under all masks are hashed once; every window of
every training text is hashed under the same masks and looked up. On the diagonal of each hit
the whole item is compared with the text token by token, without gaps. An overlap is any
stretch of it that has ``MIN_MATCHES`` equal tokens, or four in five of a shorter item, and
at least ``MIN_SHARE`` of whose tokens are equal; the one with most equal tokens is reported.

Test items are a stated set of queries against all documents. They are taken in blocks of at
most ``BLOCK_TOKENS`` tokens, and each block goes over all documents once, so what is sent to
the tasks is bounded however large the benchmark is.

Defined cases: null texts and texts without tokens overlap with nothing; short items have
masks of their own, items of up to four tokens one of all their tokens; repeated rows are
reported once each, an item without an id with a null; hits are worked on ``SLICE`` at a time; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from viewstar.llm.text import WHITE_SPACE, hashed_words, mixed, row_chunks, window_hashes

#: Places that count, of a window. No stretch that may be an overlap hides from all of them.
MASKS = (
    (0, 1, 2, 3, 4, 5),
    (0, 1, 2, 4, 6, 7),
    (0, 1, 2, 4, 5, 8),
)
_FIVE = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5))
_FOUR = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4))
#: By tokens of the item: the masks that find it through as many substitutions as it may have.
SHORT_MASKS = {
    1: ((0,),), 2: ((0, 1),), 3: ((0, 1, 2),), 4: ((0, 1, 2, 3),), 5: ((0, 1, 2), (0, 1, 3)),
    6: _FOUR, 7: _FOUR, 8: _FIVE, 9: _FIVE, 10: _FOUR, 11: _FOUR, 12: _FIVE, 15: _FIVE,
}
MIN_MATCHES = 13
MIN_SHARE = 0.8
DROP = 6
BLOCK_TOKENS = 250_000
#: Hits worked on at once.
SLICE = 1 << 20

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SEPARATORS = WHITE_SPACE.copy()
SEPARATORS[[ord(c) for c in PUNCTUATION]] = True
TOKEN = re.compile("[^\\x20\\x09-\\x0D" + re.escape(PUNCTUATION) + "]+")

OVERLAP = ("doc_id long, item_id long, n_matches int, n_overlap int, doc_start int, "
           "item_start int, item_tokens int")


def _tokens(column: pa.Array):
    """Hashed tokens of a text column in lower case; the same for items and documents."""
    return hashed_words(pc.utf8_lower(pc.fill_null(column, "")), SEPARATORS)


class Block:
    """Hashed items: their tokens end to end, and every masked window as a sorted hash table."""

    def __init__(self, item_ids: list[int | None], texts: list[str]):
        self.item_ids = item_ids
        self.tokens, self.first = _tokens(pa.array(texts, pa.string()))
        counts = np.diff(self.first)
        owner = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(self.tokens)) - self.first[owner]
        self.tables = []
        sizes: dict[tuple, list[int]] = {}
        for size in np.unique(counts[counts > 0]).tolist():
            for mask in SHORT_MASKS.get(size, MASKS):
                sizes.setdefault(mask, []).append(size)
        for mask, some in sizes.items():
            hashes = window_hashes(self.tokens, mask)
            room = counts[owner[:len(hashes)]]
            fits = np.isin(room, some) & (within[:len(hashes)] + mask[-1] < room)
            self._add(mask, hashes[fits], np.flatnonzero(fits), owner)

    def _add(self, mask, hashes, places, owner) -> None:
        """A table by window, and in it by the window before in the same item, if there is one."""
        owners = owner[places]
        follows = np.append(False, (owners[1:] == owners[:-1]) & (places[1:] == places[:-1] + 1))
        before = np.where(follows, np.append(NO_ITEM, hashes[:-1])[:len(hashes)], NO_ITEM)
        order = np.lexsort((before, hashes))
        hashes, before = hashes[order], before[order]
        both = _both(hashes, before)
        edge = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1])
                                        | (before[1:] != before[:-1]))[:len(both)])
        ends = np.append(edge[1:], len(both))
        by_pair = np.argsort(both[edge], kind="stable")
        self.tables.append(Table(mask, hashes, places[order], owners[order], both[edge][by_pair],
                                 edge[by_pair], ends[by_pair]))


#: Stand for the window before the first of an item, and of a document.
NO_ITEM, NO_DOCUMENT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _both(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    return mixed(hashes * np.uint64(0xD6E8FEB86659FD93) + mixed(before))


class Table(NamedTuple):
    """Windows of the items under one mask, sorted; ``pairs`` are the distinct pairs of a
    window and the one before it, and where their rows begin and end."""

    mask: tuple[int, ...]
    hashes: np.ndarray
    places: np.ndarray
    items: np.ndarray
    pairs: np.ndarray
    begins: np.ndarray
    ends: np.ndarray


def _ranges(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """begin, begin + 1, … of each range, end to end."""
    return np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _found(values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value stands in sorted ``values``, and whether it does."""
    at = np.searchsorted(values, wanted)
    at[at == len(values)] = 0
    return at, values[at] == wanted


def _hits(block: Block, tokens: np.ndarray, first: np.ndarray):
    """Slices of (document, item, diagonal) that share a masked window, each diagonal at the start
    of a run of hits: at most ``SLICE`` and one window's hits at a time.

    A hit whose windows before it are equal too goes on with a run, and is never written out:
    a token that repeats in text and item costs one hit per diagonal, not one per pair.
    """
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    for table in block.tables:
        windows = window_hashes(tokens, table.mask)
        if not len(windows) or not len(table.hashes):
            continue
        low, same = _found(table.hashes, windows)
        at = np.flatnonzero(
            same & (np.arange(len(windows)) + table.mask[-1] < first[1:][owner[:len(windows)]]))
        if not len(at):
            continue
        begin = low[at]
        high = np.searchsorted(table.hashes, windows[at], side="right")
        before = np.where(at > first[owner[at]], windows[at - 1], NO_DOCUMENT)
        pair, known = _found(table.pairs, _both(windows[at], before))
        # The rows that go on with a run stand together; those before and after them count.
        inner = np.where(known, table.begins[pair], high)
        outer = np.where(known, table.ends[pair], high)
        for starts, many in ((begin, inner - begin), (outer, high - outer)):
            some = np.flatnonzero(many)
            total = np.cumsum(many[some])
            done = 0
            while done < len(some):
                reached = total[done - 1] if done else 0
                end = max(done + 1, int(np.searchsorted(total, reached + SLICE, side="right")))
                part = some[done:end]
                rows = _ranges(starts[part], many[part])
                places = np.repeat(at[part], many[part])
                found = np.stack((owner[places], table.items[rows], places - table.places[rows]))
                found = found[:, np.lexsort(found[::-1])]
                fresh = np.append(True, (found[:, 1:] != found[:, :-1]).any(axis=0))
                yield found[:, fresh]
                done = end


def _extended(equal: np.ndarray, at: int) -> tuple[int, int]:
    """Range of the best-scoring stretch around ``at`` on one diagonal: a lower bound that the
    tests hold overlaps against. The operator does not grow overlaps (``_best_stretch``)."""
    def reach(steps: np.ndarray) -> int:
        best = score = far = 0
        for n, same in enumerate(steps.tolist(), 1):
            score += 1 if same else -2
            if score > best:
                best, far = score, n
            elif score < best - DROP:
                break
        return far
    return at - reach(equal[:at][::-1]), at + reach(equal[at:])


def _best_stretch(equal: np.ndarray, enough: int) -> tuple[int, int, int] | None:
    """(equal tokens, start, end) of the stretch with the most equal tokens among all stretches
    of one diagonal in which ``MIN_SHARE`` is equal; None if it has fewer than ``enough``."""
    if np.count_nonzero(equal) < enough:
        return None
    share = Fraction(str(MIN_SHARE))
    matches = np.concatenate(([0], np.cumsum(equal)))
    # A stretch has the share if this is no lower at its end than at its start.
    height = matches * share.denominator - np.arange(len(matches)) * share.numerator
    start = np.searchsorted(-np.minimum.accumulate(height), -height)
    held = matches - matches[start]
    end = int(np.argmax(held))
    if held[end] < enough:
        return None
    begin = int(start[end])
    return int(held[end]), begin + int(np.argmax(equal[begin:end])), end


def _overlaps(block: Block, tokens: np.ndarray, first: np.ndarray):
    """(document, item, matches, length, document start, item start) of verified overlaps,
    the best per document and item."""
    best: dict[tuple[int, int], tuple] = {}
    for hits in _hits(block, tokens, first):
        for d, i, shift in hits.T.tolist():
            item_start, item_end = int(block.first[i]), int(block.first[i + 1])
            low = max(item_start, int(first[d]) - shift)
            high = min(item_end, int(first[d + 1]) - shift)
            known = best.get((d, i))
            # Of equal overlaps the one on the least diagonal counts.
            if known is not None and (known[0], -known[1]) >= (high - low, -shift):
                continue
            equal = block.tokens[low:high] == tokens[low + shift:high + shift]
            stretch = _best_stretch(equal, min(MIN_MATCHES, -(-(item_end - item_start) * 4 // 5)))
            if stretch is None:
                continue
            matches, left, right = stretch
            if known is None or (matches, -shift) > (known[0], -known[1]):
                best[d, i] = (matches, shift, right - left, low + left + shift - int(first[d]),
                              low + left - item_start)
    for (d, i), (matches, _, *rest) in best.items():
        yield d, i, matches, *rest


def _search(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            rows = []
            for start, end in row_chunks(batch.column("text")):
                words = _tokens(batch.column("text").slice(start, end - start))
                for d, i, *rest in _overlaps(block, words.words, words.first):
                    rows.append((ids[start + d].as_py(), block.item_ids[i], *rest,
                                 int(block.first[i + 1] - block.first[i])))
            kinds = [pa.int64(), pa.int64()] + [pa.int32()] * 5
            names = [c.split()[0] for c in OVERLAP.split(", ")]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
    return run


def _blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The items in blocks bounded by their tokens."""
    items = benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ids, texts, held = [], [], 0
    for row in items.toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"])
        held += len(TOKEN.findall(row["text"]))
        if held >= BLOCK_TOKENS:
            yield Block(ids, texts)
            ids, texts, held = [], [], 0
    if ids:
        yield Block(ids, texts)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that overlap: the best overlap, where it is, how long."""
    texts = docs.select("doc_id", "text")
    found = None
    for block in _blocks(benchmark):
        part = texts.mapInArrow(_search(block), OVERLAP)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], OVERLAP) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that overlap with no item, with their columns unchanged.

    Rows are kept by what their own text holds, whatever their id: the search sets a mark in
    the row itself, so nothing is joined and no text moves.
    """
    for block in _blocks(benchmark):
        docs = docs.mapInArrow(_without_overlap(block), docs.schema)
    return docs


def _without_overlap(block: Block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = np.ones(batch.num_rows, bool)
            for start, end in row_chunks(batch.column("text")):
                words = _tokens(batch.column("text").slice(start, end - start))
                for d, *_ in _overlaps(block, words.words, words.first):
                    stay[start + d] = False
            yield batch.filter(pa.array(stay))
    return run
