"""Counts against the tokenizers library's Unigram model with the same pieces and scores."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from viewstar.llm import viterbi_counts as v
from viewstar.llm.queries import op6_token_counts
from llm_cases import LONG, LONG_WORD, SMALL, documents, small  # noqa: F401

PATH = public_tokenizers.path("piece_bpe_32k.model")


def reference(pieces, byte_fallback):
    """The library's model; byte pieces only serve the fallback."""
    vocabulary = [("<unk>", 0.0), *pieces.items()]
    if byte_fallback:
        low = min(pieces.values())
        vocabulary += [(f"<0x{b:02X}>", low) for b in range(256)]
    model = Tokenizer(models.Unigram(vocabulary, 0, byte_fallback))
    return lambda text: len(model.encode(text).ids)


def prepared(text):
    return v.BLANK + text.replace(" ", v.BLANK) if text else ""


@pytest.fixture(scope="module")
def pieces():
    return v.vocabulary(PATH)[0]


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_counts_equal_the_library(pieces, byte_fallback):
    count, want = v.Counter(pieces, byte_fallback).count, reference(pieces, byte_fallback)
    pick = random.Random(8)
    parts = list("abcdet é\n\t中😀…") + ["th", "the", "ing", " the", "  ", "\n\n"]
    for _ in range(6000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 30)))
        assert count(text) == want(prepared(text)), repr(text)


def test_ties_keep_the_longer_last_piece():
    pieces = {"▁": -1.0, "a": -1.0, "b": -1.0, "ab": -2.0, "▁a": -2.0, "aa": -2.0, "▁aab": -9.0}
    counter, want = v.Counter(pieces, False), reference(pieces, False)
    pick = random.Random(1)
    for _ in range(3000):
        text = "".join(pick.choice("ab z ") for _ in range(pick.randint(1, 12)))
        assert counter.count(text) == want(prepared(text)), repr(text)


def test_whole_query_equals_the_library(spark, small, pieces):
    want = reference(pieces, True)
    got = {r["doc_id"]: r["n_tokens"] for r in op6_token_counts(spark, SMALL).collect()}
    assert got == {r["doc_id"]: want(prepared(r["text"])) for r in small("documents").collect()}


def test_defined_cases(spark, documents, pieces, monkeypatch):
    monkeypatch.setattr(v, "CACHE_BYTES", 2000)
    rows = [(1, None), (2, ""), (3, " "), (4, "\n"), (5, LONG), (6, LONG_WORD), (7, "a"),
            (7, "a"), (None, " a  b ")]
    got = [tuple(r) for r in v.token_counts(
        documents(rows).withColumnRenamed("lang", "n_tokens"), PATH).collect()]
    want = reference(pieces, True)
    assert got == [(d, want(prepared(t or ""))) for d, t in rows]
    assert v.token_counts(documents([]), PATH).count() == 0
    with pytest.raises(ValueError):
        v.Counter({"a▁b": -1.0})


def test_remembered_stretches_are_bounded_by_bytes():
    from viewstar.llm import viterbi_counts as v
    counter = v.Counter({"a": -1.0, "ab": -1.5, v.BLANK: -2.0})
    long = ["ab" * 2500 + str(n) for n in range(300)]
    want = [counter.count(text) for text in long]
    assert counter.held == 0 and not counter.blank
    limit, v.CACHE_BYTES = v.CACHE_BYTES, 50_000
    try:
        counts = [counter.count(f"x{n} ab") for n in range(2000)]
        assert counter.held <= 51_000 and len(counter.blank) < 300
    finally:
        v.CACHE_BYTES = limit
    assert counts == [v.Counter({"a": -1.0, "ab": -1.5, v.BLANK: -2.0}).count(f"x{n} ab")
                      for n in range(2000)]
    assert want == [counter.count(text) for text in long]
