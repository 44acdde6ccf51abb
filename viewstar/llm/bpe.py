"""Byte-level BPE of whole text columns: each distinct piece goes through the tokenizer once.

A byte-level BPE tokenizer first cuts a text into pieces and then merges bytes within each
piece, so the ids of a text are those of its pieces, end to end. The cut is made for a whole
column in numpy, from classes of characters asked of the tokenizer itself; equal pieces are
found by a 64-bit hash; only pieces not met before in this Python worker are merged.
Added tokens of the tokenizer file (``<|endoftext|>``) are no pieces: a text is split at them
first, and each becomes its own id, as in the tokenizer's ``encode``.
``tests/llm/test_grammar_ids.py`` holds the result against the tokenizer's own ``encode``.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from viewstar.llm.text import span_hashes, text_buffer

#: Pieces (24 bytes each) and ids (4 bytes each) a worker remembers; beyond either, of which a
#: piece has no more than bytes, the next chunk starts anew.
CACHE_PIECES = 3_000_000
CACHE_IDS = 16_000_000

LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
# Endings that the cut keeps with their apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


#: Hashes met lately stand in so many slots, so that common pieces are found without a sort.
_FRONT = 20
#: Bytes of new pieces that go to the tokenizer in one call.
LEARN_BYTES = 1 << 18


class PieceTable:
    """Ids of distinct pieces, found by a 64-bit hash; ``tokenize`` is asked once per piece.

    It takes some pieces and gives the ids of all, end to end, and how many each has.
    """

    def __init__(self, tokenize: Callable[[list[bytes]], tuple[Sequence[int], Sequence[int]]]):
        self.tokenize = tokenize
        self._forget()

    def _forget(self) -> None:
        # Sorted hashes of the pieces known, and the slot of each.
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        # By the first bits of the hash, the last piece met: its hash and slot.
        self.front_keys = np.zeros(1 << _FRONT, np.uint64)
        self.front_slots = np.full(1 << _FRONT, -1, np.int32)
        self.known = 0
        self.lengths = np.zeros(1 << 12, np.int32)
        self.starts = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _learn(self, pieces: list[bytes]) -> None:
        ids, counts = self.tokenize(pieces)
        counts = np.asarray(counts, np.int64)
        known, used = self.known + len(pieces), self.used + len(ids)
        while known > len(self.lengths):
            self.lengths = np.concatenate((self.lengths, np.zeros_like(self.lengths)))
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
        while used > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.lengths[self.known:known] = counts
        self.starts[self.known:known] = self.used + np.cumsum(counts) - counts
        self.ids[self.used:used] = ids
        self.known, self.used = known, used

    def _find(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray,
              ends: np.ndarray) -> np.ndarray | None:
        """Slots of pieces that are not in front, by their hashes; None if there is no room."""
        keys, where, back = np.unique(keys, return_index=True, return_inverse=True)
        if self.known and (self.known + len(keys) > CACHE_PIECES or self.used > CACHE_IDS):
            return None
        place = np.searchsorted(self.keys, keys)
        fresh = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        fresh[inside] = self.keys[place[inside]] != keys[inside]
        before, at = self.known, where[fresh]
        spans = list(zip(starts[at].tolist(), ends[at].tolist()))
        whole = data.tobytes() if spans else b""
        sizes = np.cumsum(ends[at] - starts[at]) // LEARN_BYTES
        edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(spans)]
        for first, last in zip(edges, edges[1:]):
            if first < last:
                self._learn([whole[start:end] for start, end in spans[first:last]])
        slots = np.empty(len(keys), np.int32)
        slots[fresh] = np.arange(before, self.known)
        slots[~fresh] = self.slots[place[~fresh]]
        self.slots = np.insert(self.slots, place[fresh], slots[fresh])
        self.keys = np.insert(self.keys, place[fresh], keys[fresh])
        in_front = (keys >> np.uint64(64 - _FRONT)).astype(np.int64)
        self.front_keys[in_front], self.front_slots[in_front] = keys, slots
        return slots[back]

    def ids_of(self, data: np.ndarray, starts: np.ndarray,
               ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and the place of each piece's first id (plus the end)."""
        keys = span_hashes(data, starts, ends)
        in_front = (keys >> np.uint64(64 - _FRONT)).astype(np.int64)
        slots = self.front_slots[in_front]
        missing = np.flatnonzero((self.front_keys[in_front] != keys) | (slots < 0))
        found = self._find(keys[missing], data, starts[missing], ends[missing])
        if found is None:
            # Full: all pieces of this chunk are learned anew.
            self._forget()
            slots, missing = np.empty(len(keys), np.int32), slice(None)
            found = self._find(keys, data, starts, ends)
        slots[missing] = found
        lengths = self.lengths[slots].astype(np.int64)
        after = np.concatenate(([0], np.cumsum(lengths)))
        ids = self.ids[np.repeat(self.starts[slots] - after[:-1], lengths)
                       + np.arange(int(after[-1]))]
        return ids, after


class PieceEncoder:
    """Encodes columns of ordinary text, in which the text of an added token means nothing."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.classes = np.zeros(0x110000, np.uint8)
        model = self.tokenizer.model
        # The character of each byte, as the model writes it.
        characters = byte_characters()
        self._characters = np.array([ord(characters[b]) for b in range(256)], np.uint32)
        self.table = PieceTable(functools.partial(self._merged, model.tokenize))

    def _merged(self, tokenize, pieces: list[bytes]) -> tuple[list[int], list[int]]:
        """Ids of some pieces end to end, and how many each has."""
        text = self._characters[np.frombuffer(b"".join(pieces), np.uint8)].tobytes().decode(
            "utf-32-le")
        ids, counts, start = [], [], 0
        for piece in pieces:
            end = start + len(piece)
            found = [token.id for token in tokenize(text[start:end])]
            ids += found
            counts.append(len(found))
            start = end
        return ids, counts

    def _class_of(self, code: int) -> int:
        def together(other: str) -> bool:
            return len(self.tokenizer.pre_tokenizer.pre_tokenize_str(other + chr(code))) == 1
        if together("a"):
            return LETTER
        if together("1"):
            return NUMBER
        return OTHER if together("!") else SPACE

    def _cut(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Places where a piece starts; ``first`` are the starts of the documents."""
        known = np.flatnonzero(np.bincount(codes, minlength=1))
        for code in known[self.classes[known] == 0].tolist():
            self.classes[code] = self._class_of(code)
        kind = self.classes[codes]
        begins = np.zeros(len(codes) + 1, bool)
        begins[first] = True
        begins = begins[:-1]
        same = np.zeros(len(codes), bool)
        same[1:] = kind[1:] == kind[:-1]
        start = begins | ~same
        white = kind == SPACE
        # The last white character before a word is a piece of its own, or joins the word
        # if it is a blank; a run of white space at the end of a text stays whole.
        before_word = np.zeros(len(codes), bool)
        before_word[:-1] = white[:-1] & ~white[1:] & ~begins[1:]
        start |= before_word
        joined = np.zeros(len(codes), bool)
        joined[1:] = before_word[:-1] & (codes[:-1] == 0x20)
        start &= ~joined
        quotes = np.flatnonzero((codes == 0x27) & start)
        if len(quotes):
            at_end = np.append(begins[1:], True)
            for at in quotes.tolist():
                for ending in CONTRACTIONS:
                    end = at + 1 + len(ending)
                    if end <= len(codes) and not at_end[at:end - 1].any() and (
                            codes[at + 1:end].tolist() == [ord(c) for c in ending]):
                        start[at + 1] = False
                        if end < len(codes):
                            start[end] |= not joined[end]
                        break
        return np.flatnonzero(start)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the place of each text's first id (plus the end)."""
        data, offsets = text_buffer(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        if data.max() < 0x80:
            # One byte per character: places in the text are places in the bytes.
            first = offsets
            cuts = starts = self._cut(data, first)
        else:
            heads = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
            codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
            first = np.searchsorted(heads, offsets)
            cuts = self._cut(codes, first)
            starts = heads[cuts]
        ends = np.append(starts[1:], len(data))
        ids, after = self.table.ids_of(data, starts, ends)
        return ids, after[np.searchsorted(cuts, first)]


class TextEncoder:
    """Encodes columns; one per worker and vocabulary (``encoder``)."""

    def __init__(self, path: str):
        self.pieces = PieceEncoder(path)
        added = self.pieces.tokenizer.get_added_tokens_decoder()
        self.added = {token.content: number for number, token in added.items()}
        #: Tokens that take in their surroundings, or are looked for in two passes, are left
        #: to the tokenizer.
        self.literal = len({t.normalized for t in added.values()}) < 2 and not any(
            t.lstrip or t.rstrip or t.single_word for t in added.values())
        # The longest token wins where two start at one place.
        self.pattern = re.compile(
            "(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the place of each text's first id (plus the end)."""
        column = pc.fill_null(column, "")
        if not any(pc.any(pc.match_substring(column, token)).as_py() for token in self.added):
            return self.pieces.encode(column)
        if not self.literal:
            found = [self.pieces.tokenizer.encode(text, add_special_tokens=False).ids
                     for text in column.to_pylist()]
            return (np.array([i for ids in found for i in ids], np.uint32),
                    np.cumsum([0] + [len(ids) for ids in found]))
        # Per text the parts between its tokens, and each token after the part before it.
        parts, tokens, after, head, before = [], [], [], [], []
        for text in column.to_pylist():
            head.append(len(parts))
            before.append(len(tokens))
            split = self.pattern.split(text)
            after.extend(range(len(parts) + 1, len(parts) + 1 + len(split) // 2))
            parts.extend(split[::2])
            tokens.extend(self.added[token] for token in split[1::2])
        ids, first = self.pieces.encode(pa.array(parts, column.type))
        return (np.insert(ids, first[after], np.array(tokens, ids.dtype)),
                first[head + [len(parts)]] + np.array(before + [len(tokens)]))


@functools.cache
def encoder(path: str) -> TextEncoder:
    return TextEncoder(path)
