"""Quality rules: a table of thresholds compiled into one Spark projection, no user functions.

Every measure of a text is taken in one projection over the whole text. Words are
``[^\\x20\\x09-\\x0D]+``; lines are the ``\\n``-split lines that hold a word.

Defined cases: a null text is an empty text; a text without words fails the base rule; equal
rows get equal answers; an empty table gives an empty result; columns of the input named like a
measure stay as they are, as the measures come back in one struct column named by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from viewstar.llm.names import free_name, own_columns

SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on as with be by this are from or an at",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "le la de et les des un une est que en du dans pour qui au sur par avec pas",
    "es": "el la de que y en los se del las un por con una su para es no al lo",
}


class Rule(NamedTuple):
    """A text passes if ``lower <= measure / per <= upper``; ``per`` of None divides by one."""

    measure: str
    per: str | None
    lower: float | None
    upper: float | None


#: The base rule comes first and is fixed: words, and words in repeated windows.
MIN_WORDS = 50
MAX_REPEATED = 0.5

RULES = (
    Rule("word_chars", "n_words", 2.0, 12.0),
    Rule("n_symbols", "n_words", None, 0.1),
    Rule("n_stop_words", "n_words", 0.06, None),
    Rule("n_dup_lines", "n_lines", None, 0.6),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words that stand in a ``size``-word window found twice or more, the first one included.

    Only a text with an equal pair of 64-bit window hashes is looked at closer: its windows
    are sorted by hash, and a window whose neighbour has the same words is repeated.
    """
    def word(at: Column, k: int) -> Column:
        return F.get(words, at + F.lit(k))

    def hashed(at: Column) -> Column:
        return F.xxhash64(*[word(at, k) for k in range(size)])

    def same(x: Column, y: Column) -> Column:
        equal = x["h"] == y["h"]
        for k in range(size):
            equal = equal & (word(x["at"], k) == word(y["at"], k))
        return equal

    def covered(ordered: Column) -> Column:
        again = F.filter(ordered, lambda x, i: (
            same(x, F.get(ordered, i + 1)) | same(x, F.get(ordered, i - 1))))
        places = F.flatten(F.transform(
            again, lambda x: F.array(*[x["at"] + F.lit(k) for k in range(size)])))
        return F.size(F.array_distinct(places))

    def of_hashes(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(F.sort_array(placed), covered))

    starts = F.sequence(F.lit(0), F.size(words) - F.lit(size))
    return F.when(F.size(words) <= size, F.lit(0)).otherwise(
        let(F.transform(starts, hashed), of_hashes))


def measures(text: Column, stop_words: Sequence[str]) -> Column:
    """A struct of all measures of a text."""
    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*stop_words))).cast("long")
            .alias("n_stop_words"),
            repeated_words(words).cast("long").alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return F.struct(
        let(words_of(text), of_words).alias("words"), let(lines, of_lines).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))


def passes(rules: Sequence[Rule], column: Callable[[str], Column]) -> Column:
    """The table of thresholds as one condition over measures."""
    verdict = F.lit(True)
    for rule in rules:
        share = column(rule.measure).cast("double")
        if rule.per:
            share = share / F.greatest(column(rule.per), F.lit(1)).cast("double")
        if rule.lower is not None:
            verdict = verdict & (share >= F.lit(float(rule.lower)))
        if rule.upper is not None:
            verdict = verdict & (share <= F.lit(float(rule.upper)))
    return verdict


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_stop_words", "n_lines")


def judged(docs: DataFrame, name: str, rules: Sequence[Rule] = RULES,
           text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``name``: all measures, base_failed, kept."""
    stop_words = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    raw = f"{name}_raw"
    docs = docs.withColumn(raw, measures(F.col(f"`{text}`"), stop_words))

    def column(measure: str) -> Column:
        inner = {"n_lines": "lines.", "n_dup_lines": "lines.", "n_symbols": ""}.get(
            measure, "words.")
        return F.col(f"{raw}.{inner}{measure}")

    base_failed = (column("n_words") < MIN_WORDS) | (
        column("n_repeat_words") > MAX_REPEATED * column("n_words"))
    return docs.withColumn(name, F.struct(
        *[column(m).alias(m) for m in MEASURES], base_failed.alias("base_failed"),
        (~base_failed & passes(rules, column)).alias("kept"))).drop(raw)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents that pass, with their columns unchanged."""
    name = free_name(docs, "_quality")
    return judged(docs, name, rules).where(f"{name}.kept").select(*own_columns(docs))
