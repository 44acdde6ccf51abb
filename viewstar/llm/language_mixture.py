"""Language proportions of each document, by expectation-maximisation over its words.

Every language has a model of letter trigrams given the two letters before, with hashed tables.
A word's likelihood under a language is the product over its letters; a document is a mixture of
languages, and EM finds the proportions under which its words are likeliest. From the whole set
of languages the least one is taken out again and again as long as the penalised likelihood
(half the logarithm of the word count per free proportion) does not fall. The set that remains
is the document's languages; the predicted one has the largest proportion.

Learning counts trigrams on the cluster, from at most ``TRAIN_ROWS`` labelled rows per language
of at most ``TRAIN_CHARS`` characters, and of at most ``MAX_LANGUAGES`` languages, the most common
ones (the documented bounds). Prediction reads every text whole. What travels to tasks is one
table of ``BUCKETS`` numbers per language and order.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and no shares; so is
every text where nothing was learned. A text in an unknown script gets equal shares and the first
language by code point, as do ties. Letters are compared in lower case and composed form; marks
belong to the word they stand in; a run of over ``WORD`` letters counts as several words. Repeated
rows get equal results; an empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from viewstar.llm.text import row_chunks, text_buffer

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
TRAIN_ROWS = 1500
#: A longer text is left out of the training sample, never out of prediction.
TRAIN_CHARS = 20_000
MAX_LANGUAGES = 512

#: Longest run of letters that counts as one word.
WORD = 32
#: Added to each count of a trigram, and the letters it is shared by.
ADDED, LETTERS = 0.1, 64
ROUNDS = 30
CLOSE = 1e-4
#: Work tables of words by languages are kept below this many numbers.
TABLE = 4_000_000

UNKNOWN = "und"
RESULT = ("doc_id long, lang_pred string, score double, "
          "shares array<struct<lang:string,share:double>>")

_ODD = np.random.default_rng(12).integers(0, 2**63, 5, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Letters(NamedTuple):
    """Letters of some texts, each run followed by one 0; text d has places first[d]:first[d+1].

    ``words`` are the places where a word starts, ``of`` the text of each word.
    """

    three: np.ndarray
    two: np.ndarray
    words: np.ndarray
    of: np.ndarray


@functools.cache
def _folded() -> np.ndarray:
    """Per code point the lower-case letter, or 0 if it is neither a letter nor a mark."""
    fold = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))
        if kind[0] in "LM":
            lower = chr(code).lower()
            fold[code] = ord(lower) if len(lower) == 1 else code
    return fold


@functools.cache
def _letter() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[by:] = x[:-by] if by else x
    return out


def letters(column: pa.Array) -> Letters:
    # A blank ends every text, so that no word runs into the next text.
    column = pc.binary_join_element_wise(
        pc.utf8_normalize(pc.fill_null(column, "").cast(pa.large_string()), "NFC"),
        pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    data, offsets = text_buffer(column)
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    first = np.searchsorted(np.flatnonzero((data & 0xC0) != 0x80), offsets)
    folded = _folded()[codes]
    inside = folded != 0
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    # A run of marks alone is no word.
    marks = np.flatnonzero(inside & ~_letter()[codes])
    if len(marks):
        starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
        has = np.add.reduceat(_letter()[codes] & inside, starts) > 0
        run = np.searchsorted(starts, np.arange(len(codes)), side="right") - 1
        keep &= (run >= 0) & has[np.maximum(run, 0)]
    kept = folded[keep].astype(np.uint64)
    first = np.concatenate(([0], np.cumsum(keep)))[first]
    before = _shifted(kept, 1)
    further = np.where(before == 0, 0, _shifted(kept, 2)).astype(np.uint64)
    shift = np.uint64(64 - BUCKET_BITS)
    two = further * _ODD[0] + before * _ODD[1]
    three = (two ^ (two >> np.uint64(31))) * _ODD[2] + kept * _ODD[3]
    begins = np.flatnonzero(before == 0)
    if len(begins) and np.diff(np.append(begins, len(kept))).max() > WORD:
        place = np.arange(len(kept)) - begins[
            np.searchsorted(begins, np.arange(len(kept)), side="right") - 1]
        # The end of a word is no word of its own.
        begins = np.flatnonzero((place % WORD == 0) & ((place == 0) | (kept != 0)))
    return Letters(
        ((three * _ODD[4]) >> shift).astype(np.int32), ((two * _ODD[4]) >> shift).astype(np.int32),
        begins, np.searchsorted(first, begins, side="right") - 1)


class Model(NamedTuple):
    """Languages in order, and the logarithms of their smoothed counts by bucket."""

    languages: list[str]
    three: np.ndarray
    two: np.ndarray


def held_out(doc_id: str) -> Column:
    """Documents whose language is never learned."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the buckets of each language, over all of one task's rows."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang in pc.unique(batch.column("lang")).to_pylist():
            column = batch.filter(pc.equal(batch.column("lang"), lang)).column("text")
            if lang not in counts:
                counts[lang] = np.zeros((2, BUCKETS), np.int64)
            for start, end in row_chunks(column):
                found = letters(column.slice(start, end - start))
                counts[lang][0] += np.bincount(found.three, minlength=BUCKETS)
                counts[lang][1] += np.bincount(found.two, minlength=BUCKETS)
    for lang, table in counts.items():
        kind, bucket = np.nonzero(table)
        yield pa.record_batch({
            "lang": pa.array([lang] * len(kind), pa.string()), "kind": pa.array(kind, pa.int32()),
            "bucket": pa.array(bucket, pa.int32()), "n": pa.array(table[kind, bucket])})


def sample(docs: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS,
           languages: int = MAX_LANGUAGES) -> DataFrame:
    """Texts and languages to learn from: at most ``rows`` of each language, by hashes of ids.

    The ids are chosen without their texts.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).where(
        ~held_out("doc_id") & (F.length("text") <= chars)).select("doc_id", "lang")
    common = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "lang").limit(languages)
    hashed = F.xxhash64("doc_id")
    order = Window.partitionBy("lang").orderBy(hashed, "doc_id")
    # Of a language with many rows those with low hashes, some more than needed, so that no
    # task ranks a language whole.
    share = F.lit(2.0 * rows) / F.col("n")
    low = (F.pmod(hashed, F.lit(1 << 20)) / (1 << 20)) < share
    chosen = known.join(F.broadcast(common), "lang").where(low).drop("n").withColumn(
        "place", F.row_number().over(order)).where(F.col("place") <= rows)
    chosen = chosen.select("doc_id", "lang").distinct()
    return docs.select("doc_id", "lang", "text").where(F.length("text") <= chars).join(
        F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text")


def train(labelled: DataFrame) -> Model:
    """The model of the languages in ``labelled`` (lang, text); at most ``MAX_LANGUAGES`` of them."""
    counted = labelled.select("lang", "text").mapInArrow(
        _counted, "lang string, kind int, bucket int, n long")
    found = counted.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(pc.unique(found.column("lang")).to_pylist())
    row = np.searchsorted(np.array(languages, object), found.column("lang").to_numpy(
        zero_copy_only=False)) if languages else np.zeros(0, np.int64)
    counts = np.zeros((2, len(languages), BUCKETS))
    counts[found.column("kind").to_numpy(), row, found.column("bucket").to_numpy()] = (
        found.column("n").to_numpy())
    return Model(languages, np.log(counts[0] + ADDED).astype(np.float32),
                 np.log(counts[1] + ADDED * LETTERS).astype(np.float32))


def _sums(values: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """Sums of rows by their document; ``of`` rises."""
    out = np.zeros((size, *values.shape[1:]))
    if len(of):
        starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        out[of[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


def proportions(likely: np.ndarray, of: np.ndarray, active: np.ndarray,
                start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM: the proportions of each document, and the logarithm of its likelihood.

    ``likely`` has a row per word and a column per language, ``of`` the document of each word,
    ``active`` the languages allowed per document.
    """
    size = len(active)
    words = np.bincount(of, minlength=size)[:, None]
    share = np.where(active, np.maximum(start, 1e-12), 0)
    share /= share.sum(axis=1, keepdims=True)
    total = np.zeros(size)
    at, of_at = likely, of
    open_ = np.ones(size, bool)
    for _ in range(ROUNDS):
        joint = at * share[of_at].astype(np.float32)
        whole = np.maximum(joint.sum(axis=1), np.float32(1e-30))
        fresh = _sums(joint / whole[:, None], of_at, size) / np.maximum(words, 1)
        logs = _sums(np.log(whole), of_at, size)
        still = open_ & (np.abs(fresh - share).max(axis=1) > CLOSE)
        share[open_], total[open_] = fresh[open_], logs[open_]
        open_ = still
        if not open_.any():
            break
        rows = open_[of_at]
        if not rows.all():
            at, of_at = at[rows], of_at[rows]
    return share, total


def language_sets(likely: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """The proportions of each document over its own set of languages.

    Languages with less than half a word go at once: that costs less likelihood than the
    penalty of one proportion. Of the others the least is tried, one at a time.
    """
    count = likely.shape[1]
    words = np.bincount(of, minlength=size)
    penalty = 0.5 * np.log(np.maximum(words, 2))
    active = np.ones((size, count), bool)
    share, _ = proportions(likely, of, active, np.full((size, count), 1 / count))
    active = share * words[:, None] >= 0.5
    active[np.arange(size), share.argmax(axis=1)] = True
    share, total = proportions(likely, of, active, share)
    open_ = np.flatnonzero(active.sum(axis=1) > 1)
    while len(open_):
        fewer = active[open_]
        least = np.where(fewer, share[open_], np.inf).argmin(axis=1)
        fewer[np.arange(len(open_)), least] = False
        where = np.full(size, -1)
        where[open_] = np.arange(len(open_))
        rows = where[of] >= 0
        less, its = proportions(likely[rows], where[of[rows]], fewer, share[open_])
        better = its - total[open_] + penalty[open_] >= 0
        gone = open_[better]
        active[gone], share[gone], total[gone] = fewer[better], less[better], its[better]
        open_ = gone[active[gone].sum(axis=1) > 1]
    return share


def word_likelihoods(found: Letters, model: Model) -> np.ndarray:
    """Per word and language the likelihood, over that of the word's likeliest language."""
    out = np.empty((len(found.words), len(model.languages)), np.float32)
    for number in range(len(model.languages)):
        logs = model.three[number][found.three] - model.two[number][found.two]
        out[:, number] = np.add.reduceat(logs, found.words)
    out -= out.max(axis=1, keepdims=True)
    return np.exp(out, out=out)


def shares(column: pa.Array, model: Model) -> np.ndarray:
    """Proportions of the languages of each text; all 0 for a text without a letter."""
    out = np.zeros((len(column), len(model.languages)))
    found = letters(column)
    if not len(found.words) or not model.languages:
        return out
    present, of = np.unique(found.of, return_inverse=True)
    out[present] = language_sets(word_likelihoods(found, model), of, len(present))
    return out


def _predicted(model: Model):
    # One text or more at a time: a letter takes some numbers, a word one per language.
    limit = max(1 << 16, min(1 << 21, TABLE * 5 // max(1, len(model.languages))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in row_chunks(batch.column("text"), limit):
                rows = batch.slice(start, end - start)
                share = shares(rows.column("text"), model)
                best = share.argmax(axis=1) if model.languages else np.zeros(len(share), int)
                score = share.max(axis=1, initial=0)
                yield pa.record_batch({
                    "doc_id": rows.column("doc_id").cast(pa.int64()),
                    "lang_pred": pa.array([model.languages[b] if s else UNKNOWN
                                           for b, s in zip(best, score)], pa.string()),
                    "score": pa.array(np.clip(score, 0, 1)),
                    "shares": pa.array(
                        [[{"lang": model.languages[k], "share": float(row[k])}
                          for k in np.flatnonzero(row)] for row in share],
                        pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))})
    return run


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, shares) of every row of ``docs``, from the whole text."""
    return docs.select("doc_id", "text").mapInArrow(_predicted(model), RESULT)
