"""Alignment of two tokenizers over the same bytes, and how often their ids meet.

Both tokenizers encode the same text; each token ends at a byte offset. The ends of each
tokenizer are put in a dictionary from end to token index. The keys that both have, sorted, cut
both id lists into groups that cover the same bytes. Within a group the links, pairs of tokens
whose byte ranges overlap, are the stretches between one token end and the next: each stretch
lies in one token of either side, and no two tokens share two stretches.

The links of a document are kept as distinct pairs with their number, in a stored table.
Documents per pair are counted over the whole corpus and looked up again: by a broadcast if the
counts measure at most ``BROADCAST_BYTES``, else by a shuffle that keeps hot pairs out
(``operators.lookup``). Pairs that one document alone holds need no row in the counts, as every
pair of the corpus counts at least one.

Tokenizer A is a byte-level file of the tokenizers library and encodes a blank and the text;
tokenizer B is a sentencepiece model, which adds that blank itself. The text of a special token
is ordinary text to both. If no piece of B goes on over a blank, which
is asked of the model, each distinct word is encoded once; else whole texts are.

Defined cases: a null or empty text, or one that either side's bytes do not give back (B reads
U+2581 as a blank), has no tokens: zeros and an empty ``groups_sha256``. Rows of a repeated or
null ``doc_id`` count as documents of their own. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from viewstar.llm.bpe import PieceEncoder, PieceTable, byte_characters
from viewstar.llm.text import row_chunks, text_buffer
from viewstar.operators.lookup import lookup
from viewstar.staging import Staging

#: A pair is one number: the id of A times this, plus the id of B.
SIDE = 1 << 20
#: Bytes of text whose ends are in the dictionaries at a time.
WINDOW = 1 << 20
#: The counts are broadcast up to this size, at ``PAIR_BYTES`` a pair.
BROADCAST_BYTES = 256 << 20
PAIR_BYTES = 40

BLANK = "▁"

ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs array<long>, times array<int>")


class Vocabulary:
    """Bytes of each token, and each id as text with the mark that follows it."""

    def __init__(self, tokens: list[bytes], inner: str, outer: str):
        if len(tokens) > SIDE:
            raise ValueError(f"a vocabulary may have {SIDE} ids, not {len(tokens)}")
        self.bytes = pa.array(tokens, pa.large_binary())
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.marked = [f"{n}{mark}" for n in range(len(tokens)) for mark in (inner, outer)]


class ByteLevel:
    """Tokenizer A."""

    def __init__(self, path: str):
        self.encoder = PieceEncoder(path)
        of = {character: byte for byte, character in byte_characters().items()}
        tokens = [b""] * self.encoder.tokenizer.get_vocab_size()
        for token, number in self.encoder.tokenizer.get_vocab().items():
            tokens[number] = (bytes(of[c] for c in token) if all(c in of for c in token)
                              else token.encode())
        self.vocabulary = Vocabulary(tokens, ",", "|")

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.encoder.encode(column)


class Pieces:
    """Tokenizer B; texts come with the blank that the model adds."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(n) for n in range(self.model.vocab_size())]
        self.vocabulary = Vocabulary([
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(number)
            else piece.replace(BLANK, " ").encode() for number, piece in enumerate(pieces)],
            ",", ";")
        self.blank = self.model.piece_to_id(BLANK)
        # A text may be cut before a run of blanks if no piece holds a blank after something
        # else and the model leaves blanks as they are.
        self.by_word = not any(BLANK in piece.lstrip(BLANK) for piece in pieces) and all(
            "".join(self.model.encode(text, out_type=str)) == BLANK + text.replace(" ", BLANK)
            for text in ("a ", "  a  a", " ", "   "))
        self.table = PieceTable(self._words)

    def _words(self, pieces: list[bytes]) -> tuple[list[int], list[int]]:
        texts = [piece.decode()[1:] for piece in pieces]
        found = [self.model.encode(text) if text else [self.blank] for text in texts]
        return [n for ids in found for n in ids], [len(ids) for ids in found]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_buffer(column)
        if not self.by_word:
            found = self.model.encode([t[1:] for t in column.to_pylist()], num_threads=1)
            return (np.array([n for ids in found for n in ids], np.uint32),
                    np.cumsum([0] + [len(ids) for ids in found]))
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(column) + 1, np.int64)
        begins = np.append(data == 0x20, False)
        begins[1:-1] &= data[:-1] != 0x20
        begins[offsets] = True
        starts = np.flatnonzero(begins[:-1])
        ids, after = self.table.ids_of(data, starts, np.append(starts[1:], len(data)))
        return ids, after[np.searchsorted(starts, offsets)]


class Pair(NamedTuple):
    a: ByteLevel
    b: Pieces
    marked: pa.Array


@functools.cache
def tokenizers(path_a: str, path_b: str) -> Pair:
    a, b = ByteLevel(path_a), Pieces(path_b)
    return Pair(a, b, pa.array(a.vocabulary.marked + b.vocabulary.marked, pa.large_string()))


def _given_back(ids: np.ndarray, first: np.ndarray, vocabulary: Vocabulary,
                data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text, whether the bytes of its tokens are those of the text."""
    if not len(ids):
        return np.diff(offsets) == 0
    ends = np.concatenate(([0], np.cumsum(vocabulary.lengths[ids])))[first]
    joined = vocabulary.bytes.take(pa.array(ids)).buffers()[2]
    joined = np.frombuffer(joined, np.uint8, int(ends[-1]))
    if np.array_equal(ends, offsets) and np.array_equal(joined, data):
        return np.ones(len(offsets) - 1, bool)
    return np.array([np.array_equal(joined[ends[n]:ends[n + 1]], data[offsets[n]:offsets[n + 1]])
                     for n in range(len(offsets) - 1)], bool)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the tokens of A, and of B, that end where a token of the other ends.

    ``ends_a`` and ``ends_b`` rise and have the same last end.
    """
    cut_a, cut_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    from_a = from_b = 0
    for border in range(WINDOW, int(ends_a[-1]) + WINDOW, WINDOW):
        to_a = int(np.searchsorted(ends_a, border, side="right"))
        to_b = int(np.searchsorted(ends_b, border, side="right"))
        index_a = dict(zip(ends_a[from_a:to_a].tolist(), range(from_a, to_a)))
        index_b = dict(zip(ends_b[from_b:to_b].tolist(), range(from_b, to_b)))
        common = sorted(index_a.keys() & index_b.keys())
        cut_a.append(np.fromiter(map(index_a.__getitem__, common), np.int64, len(common)))
        cut_b.append(np.fromiter(map(index_b.__getitem__, common), np.int64, len(common)))
        from_a, from_b = to_a, to_b
    return np.concatenate(cut_a), np.concatenate(cut_b)


class Alignment(NamedTuple):
    """Per text the counts and digest; the distinct pairs of all texts in order of text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    pairs: np.ndarray
    times: np.ndarray
    n_pairs: np.ndarray


def align(column: pa.Array, of: Pair) -> Alignment:
    """Groups and links of some texts, each beginning with the blank both sides add."""
    data, offsets = text_buffer(column)
    ids_a, first_a = of.a.encode(column)
    ids_b, first_b = of.b.encode(column)
    good = _given_back(ids_a, first_a, of.a.vocabulary, data, offsets) & _given_back(
        ids_b, first_b, of.b.vocabulary, data, offsets)
    n_a, n_b = np.where(good, np.diff(first_a), 0), np.where(good, np.diff(first_b), 0)
    if not good.all():
        ids_a = ids_a[np.repeat(good, np.diff(first_a))]
        ids_b = ids_b[np.repeat(good, np.diff(first_b))]
    size = len(column)
    zeros = np.zeros(size, np.int64)
    if not len(ids_a):
        return Alignment(n_a, n_b, zeros, zeros, [""] * size, zeros[:0], zeros[:0], zeros)
    ids_a, ids_b = ids_a.astype(np.int64), ids_b.astype(np.int64)
    ends_a = np.cumsum(of.a.vocabulary.lengths[ids_a])
    ends_b = np.cumsum(of.b.vocabulary.lengths[ids_b])
    text_ends = np.cumsum(np.where(good, np.diff(offsets), 0))
    cut_a, cut_b = common_ends(ends_a, ends_b)
    n_groups = np.diff(np.searchsorted(ends_a[cut_a], text_ends, side="right"), prepend=0)

    # The id lists, group after group, A before B, as text.
    groups_a, groups_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[cut_a], last_b[cut_b] = True, True
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    order[np.arange(len(ids_a)) + np.repeat(cut_b - groups_b + 1, groups_a)] = ids_a * 2 + last_a
    order[np.arange(len(ids_b)) + np.repeat(cut_a + 1, groups_b)] = (
        ids_b * 2 + last_b + len(of.a.vocabulary.marked))
    marked = of.marked.take(pa.array(order))
    places = np.frombuffer(marked.buffers()[1], np.int64, len(marked) + 1)
    written = memoryview(marked.buffers()[2])
    borders = places[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
    digests = [hashlib.sha256(written[start:end - 1]).hexdigest() if end > start else ""
               for start, end in zip(borders, borders[1:])]

    # The links: one per stretch between two ends.
    ends = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")
    ends = ends[np.append(ends[1:] != ends[:-1], True)]
    links = (ids_a[np.searchsorted(ends_a, ends)] * SIDE + ids_b[np.searchsorted(ends_b, ends)])
    n_links = np.diff(np.searchsorted(ends, text_ends, side="right"), prepend=0)
    text = np.repeat(np.arange(size), n_links)
    by_text = np.lexsort((links, text)) if size > 1 << 22 else np.argsort(
        (text << 40) | links, kind="stable")
    links = links[by_text]
    fresh = np.append(True, (links[1:] != links[:-1]) | (text[1:] != text[:-1]))
    heads = np.flatnonzero(fresh)
    return Alignment(n_a, n_b, n_groups, n_links, digests, links[heads],
                     np.diff(np.append(heads, len(links))),
                     np.bincount(text[heads], minlength=size))


def _aligned(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = tokenizers(path_a, path_b)
        for batch in batches:
            for start, end in row_chunks(batch.column("text")):
                rows = batch.slice(start, end - start)
                texts = pc.fill_null(rows.column("text"), "").cast(pa.large_string())
                # An empty text stays empty, so it has no tokens.
                spaced = pc.if_else(pc.equal(texts, ""), texts, pc.binary_join_element_wise(
                    pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
                found = align(spaced, of)
                borders = np.concatenate(([0], np.cumsum(found.n_pairs)))
                yield pa.record_batch({
                    "doc_id": rows.column("doc_id").cast(pa.int64()),
                    "n_a": pa.array(found.n_a, pa.int64()), "n_b": pa.array(found.n_b, pa.int64()),
                    "n_groups": pa.array(found.n_groups, pa.int64()),
                    "n_links": pa.array(found.n_links, pa.int64()),
                    "groups_sha256": pa.array(found.digests, pa.string()),
                    "pairs": pa.ListArray.from_arrays(
                        pa.array(borders, pa.int32()), pa.array(found.pairs, pa.int64())),
                    "times": pa.ListArray.from_arrays(
                        pa.array(borders, pa.int32()), pa.array(found.times, pa.int32()))})
    return run


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's token, group and link counts, and its distinct pairs with their number."""
    return docs.select("doc_id", "text").mapInArrow(_aligned(path_a, path_b), ALIGNED)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, held, best) of pairs in two documents or more.

    ``held`` is the number of documents; ``best`` is that number for the pairs of an id of A that
    have its highest, else 0.
    """
    counts = links.groupBy("pair").agg(F.count("*").alias("held")).where("held > 1")
    highest = counts.groupBy(_a("pair").alias("a")).agg(F.max("held").alias("highest"))
    # One row per id of A, so at most SIDE rows.
    return counts.join(F.broadcast(highest), _a("pair") == F.col("a")).select(
        "pair", "held", (F.col("held") == F.col("highest")).alias("best"))


def _a(pair: str):
    return F.shiftright(pair, SIDE.bit_length() - 1)


def agreement(docs: DataFrame, path_a: str, path_b: str, staging: Staging,
              broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    path = staging.path("aligned")
    found = aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    found.write.option("compression", "zstd").parquet(path)
    found = docs.sparkSession.read.schema(found.schema).parquet(path)
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    counts = staging.table(pair_counts(links), "counts")
    known = counts.select("pair", F.when(F.col("best"), F.col("held")).otherwise(
        -F.col("held")).alias("score"))
    size = counts.count() * PAIR_BYTES
    scored = lookup(links, known, "pair", "score", size, keys_of=links,
                    broadcast_bytes=broadcast_bytes)
    # An id of A without a pair in two documents has a highest count of one, reached by all.
    several = F.broadcast(counts.select(_a("pair").alias("a")).distinct())
    scored = scored.join(several, _a("pair") == F.col("a"), "left")
    best = F.coalesce(F.col("score") > 0, F.col("a").isNull())
    sums = scored.groupBy("row").agg(
        F.sum(F.when(best, F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.coalesce(F.abs("score"), F.lit(1))).alias("count_sum"))
    return found.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
