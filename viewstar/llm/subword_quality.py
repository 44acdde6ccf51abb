"""Quality classifier from supervised subword embeddings.

A document is the average of learned vectors of its words, word pairs and character n-grams,
each found by a hash in a table of ``BUCKETS`` vectors; a linear layer and a softmax give the
classes. Vectors and layer are trained together by stochastic gradient descent in numpy, on a
bounded sample of labelled rows (``TRAIN_ROWS`` and ``TRAIN_CHARS`` are the documented bounds).

Scoring reads every text whole. As both steps after the table are linear, the difference of the
two class scores is the average of one number per bucket, so that is what tasks look up: the
model that travels is one array of ``BUCKETS`` floats.

Defined cases: a null or empty text, or one without features, gets the score of the layer's
bias alone; repeated rows get equal scores; without labelled rows of both classes all scores
are the share of class 1 (or 0.5 without any); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from viewstar.llm.text import hashed_words, row_chunks, text_buffer, window_hashes

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 8
WORD_SIZES = (1, 2)
CHARACTER_SIZES = (3, 4)

TRAIN_ROWS = 3000
#: A longer text is left out of the training sample, never out of scoring.
TRAIN_CHARS = 20_000
#: Stands for a word that follows itself.
AGAIN = np.uint64(0x5EED)
EPOCHS = 4
RATE = 0.5
SEED = 11

_ODD = np.random.default_rng(5).integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Features(NamedTuple):
    """Bucket numbers of some documents; document d has ids[first[d]:first[d + 1]]."""

    ids: np.ndarray
    first: np.ndarray


def _inside(count: int, first: np.ndarray, size: int) -> np.ndarray:
    """Window starts whose window of ``size`` stays within its document."""
    ends = np.repeat(first[1:], np.diff(first))
    return np.arange(count) + size <= ends[:count]


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return ((hashes * _ODD[kind]) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def feature_parts(column: pa.Array) -> Iterator[Features]:
    """The features of a chunk of a text column, one kind after the other."""
    words = hashed_words(column)
    for size in WORD_SIZES:
        hashes = words.words
        if size > 1:
            hashes = window_hashes(words.words, tuple(range(size)))
            # A word that follows itself: repetition of any word is one and the same pair.
            hashes[(words.words[1:] == words.words[:-1])[:len(hashes)]] = AGAIN
        keep = _inside(len(hashes), words.first, size)
        yield Features(_bucket(hashes[keep], size),
                       np.concatenate(([0], np.cumsum(keep)))[np.minimum(words.first, len(keep))])
    data, offsets = text_buffer(column)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(heads, offsets)
    # White space of any kind is one character.
    codes = np.where((codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D)), 0x20, codes)
    codes = codes.astype(np.uint64)
    for size in CHARACTER_SIZES:
        count = max(0, len(codes) - size + 1)
        hashes = np.full(count, np.uint64(size))
        for place in range(size):
            hashes += codes[place:place + count] * _ODD[4 + place]
        keep = _inside(count, first, size)
        yield Features(_bucket((hashes ^ (hashes >> np.uint64(29)))[keep], size),
                       np.concatenate(([0], np.cumsum(keep)))[np.minimum(first, len(keep))])


class Model(NamedTuple):
    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def difference(self) -> tuple[np.ndarray, float]:
        """One number per bucket, and the bias: class 1 against class 0."""
        return ((self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32),
                float(self.bias[1] - self.bias[0]))


def train(texts: list[str], classes: list[int], epochs: int = EPOCHS, rate: float = RATE,
          seed: int = SEED) -> Model:
    """Stochastic gradient descent on the softmax loss, one document at a time."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    ones = sum(classes)
    if not 0 < ones < len(classes):
        share = (ones / len(classes)) if classes else 0.5
        bias[1] = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(vectors, layer, bias)
    bags = []
    for text in texts:
        ids = np.concatenate([part.ids for part in feature_parts(pa.array([text]))])
        bags.append(np.unique(ids, return_counts=True) if len(ids) else (ids, ids))
    steps, total = 0, epochs * len(bags)
    for _ in range(epochs):
        for number in random.permutation(len(bags)).tolist():
            ids, counts = bags[number]
            pace = rate * (1 - steps / total)
            steps += 1
            if not len(ids):
                continue
            weight = (counts / counts.sum())[:, None]
            mean = (vectors[ids] * weight).sum(axis=0)
            scores = mean @ layer + bias
            error = np.exp(scores - scores.max())
            error /= error.sum()
            error[classes[number]] -= 1
            back = layer @ error
            layer -= pace * np.outer(mean, error)
            bias -= pace * error
            # A document's features share its step by their weight, as in the average; the
            # factor keeps the step of a feature from vanishing in long documents.
            vectors[ids] -= pace * np.minimum(weight * len(ids), 4) * back
    return Model(vectors, layer, bias)


def _scored(numbers: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in row_chunks(batch.column("text")):
                rows = batch.slice(start, end - start)
                sums, counts = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
                for ids, first in feature_parts(rows.column("text")):
                    running = np.concatenate(([0.0], np.cumsum(numbers[ids], dtype=np.float64)))
                    sums += running[first[1:]] - running[first[:-1]]
                    counts += np.diff(first)
                difference = sums / np.maximum(counts, 1) + bias
                yield pa.record_batch({
                    "doc_id": rows.column("doc_id").cast(pa.int64()),
                    "score": pa.array(1 / (1 + np.exp(-np.clip(difference, -500, 500))))})
    return run


def held_out(doc_id: str) -> Column:
    """Documents whose labels are never learned."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS,
           chars: int = TRAIN_CHARS) -> tuple[list[str], list[int]]:
    """At most ``rows`` labelled texts of at most ``chars`` characters, in hash order of ids.

    Ids are chosen first, from the labels alone, so only chosen texts come to the driver.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).where(
        ~held_out("doc_id")).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").where(F.length("text") <= chars).join(
        F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(
        F.min("text").alias("text"))
    found = sorted((row["doc_id"], row["text"], row["quality"]) for row in texts.collect())
    return [text for _, text, _ in found], [quality for _, _, quality in found]


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``, from the whole text."""
    numbers, bias = model.difference()
    return docs.select("doc_id", "text").mapInArrow(
        _scored(numbers, bias), "doc_id long, score double")
