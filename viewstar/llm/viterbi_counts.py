"""Token counts under a unigram vocabulary, without the tokens: count-only Viterbi.

An Aho-Corasick automaton enumerates every vocabulary piece in a stretch of text; dynamic
programming carries the best score and the number of pieces to each place. The rules are those
of the Unigram model of the tokenizers library: a path is replaced only by a strictly better one, and paths into a place
are tried from the longest last piece to the shortest; a character that is no piece by itself
may also be taken as unknown at ten below the lowest score, and counts one for each of its UTF-8
bytes, or one in all per run of unknown characters where the vocabulary has no byte pieces.

No piece holds a blank after another character, so the best path splits before each blank that
follows one; line ends are in no piece at all. Each distinct stretch between them is worked out
once per Python worker, and a text's count is the sum over its stretches.

Vocabularies are SentencePiece files, read for their pieces and scores whatever their type.

Defined cases: a null or empty text counts 0; rows that repeat are counted each; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
#: Bytes of stretches a worker remembers, with what a dictionary takes; beyond that it starts anew.
CACHE_BYTES = 256 << 20
ENTRY_BYTES = 200
#: A longer stretch is not kept.
CACHE_CHARS = 256

_STRETCH = re.compile(" +[^ ]+| +")


class Counter:
    """Counts pieces of texts for one vocabulary: pieces with scores, the blank as ``▁``."""

    def __init__(self, pieces: dict[str, float], byte_fallback: bool = True):
        if any(BLANK in piece.lstrip(BLANK) or "\n" in piece for piece in pieces):
            raise ValueError("a piece holds a blank after another character, or a line end")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece in pieces if len(piece) == 1}
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        self.blank: dict[str, int] = {}
        self.bare: dict[str, int] = {}
        self.held = 0

    def _keep(self, known: dict[str, int], stretch: str, count: int) -> int:
        if len(stretch) <= CACHE_CHARS:
            known[stretch] = count
            self.held += ENTRY_BYTES + 4 * len(stretch)
        return count

    def pieces(self, stretch: str) -> int:
        """Pieces on the best path through a stretch."""
        size = len(stretch)
        best, count = [0.0] * (size + 1), [0] * (size + 1)
        # Whether the last step into a place was an unknown character.
        lost = [False] * (size + 1)
        reached = 0

        def unknown(place: int, found: bool) -> None:
            character = stretch[place - 1]
            if character in self.single:
                return
            score = best[place - 1] + self.unknown
            if found and score <= best[place]:
                return
            best[place] = score
            step = len(character.encode()) if self.byte_fallback else int(not lost[place - 1])
            count[place], lost[place] = count[place - 1] + step, True

        for last, (length, score) in self.automaton.iter(stretch):
            place = last + 1
            if place > reached:
                if reached:
                    unknown(reached, True)
                for skipped in range(reached + 1, place):
                    unknown(skipped, False)
                reached = place
                best[place] = best[place - length] + score
                count[place] = count[place - length] + 1
            elif best[place - length] + score > best[place]:
                best[place] = best[place - length] + score
                count[place] = count[place - length] + 1
        if reached:
            unknown(reached, True)
        for skipped in range(reached + 1, size + 1):
            unknown(skipped, False)
        return count[size]

    def _bare(self, stretch: str) -> int:
        """A stretch at the start of a line: no blank before it."""
        known = self.bare.get(stretch)
        if known is None:
            known = self._keep(self.bare, stretch, self.pieces(stretch.replace(" ", BLANK)))
        return known

    def __getitem__(self, stretch: str) -> int:
        """Pieces of a blank followed by ``stretch``, which holds blanks only at its start."""
        known = self.blank.get(stretch)
        if known is None:
            # Without byte pieces a run of unknown characters may go over the line end.
            if "\n" in stretch and self.byte_fallback:
                first, *rest = stretch.split("\n")
                known = self[first] + sum(1 + (self._bare(part) if part else 0) for part in rest)
            else:
                known = self.pieces(BLANK + stretch.replace(" ", BLANK))
            self._keep(self.blank, stretch, known)
        return known

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.held > CACHE_BYTES:
            self.blank.clear()
            self.bare.clear()
            self.held = 0
        if "  " in text or text[0] == " " or text[-1] == " ":
            stretches = [found[1:] for found in _STRETCH.findall(" " + text)]
        else:
            stretches = text.split(" ")
        return sum(map(self.__getitem__, stretches))


def vocabulary(path: str) -> tuple[dict[str, float], bool]:
    """Normal pieces of a SentencePiece file with their scores, and whether it has byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    normal = {model.id_to_piece(i): model.get_score(i) for i in ids
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                      or model.is_unused(i))}
    return normal, any(model.is_byte(i) for i in ids)


@functools.cache
def counter(path: str) -> Counter:
    return Counter(*vocabulary(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) for each row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_tokens": pa.array([count(text.as_py() or "") for text in batch.column("text")],
                                     pa.int64())})
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")
