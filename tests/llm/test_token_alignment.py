import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from viewstar.llm import token_alignment as ta
from viewstar.llm.bpe import byte_characters
from llm_cases import LONG, LONG_WORD, SMALL, documents, small  # noqa: F401

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

ODD = ["a", " a", "a ", "  two  blanks ", "\n\ttabs\r\n", "don't we'll", "日本語 テキスト", "🎉🎉 x", "é é",
       "<|endoftext|> <s>x</s> <0x41>", "a▁b", "▁", "x\u0000y", "１２３ 12345", "   ", " ", "　x",
       "naïve café", "ß" * 50, "a" * 500, "- " * 40]


def brute(rows):
    """The contract with the two libraries' own encoders and plain loops."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    names = {n: t for t, n in a.get_vocab().items()}
    byte_of = {c: n for n, c in byte_characters().items()}
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    out = []
    for doc_id, text in rows:
        if not text:
            out.append((doc_id, [], [], [], []))
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(byte_of[c] for c in names[n]) for n in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(n)[3:5], 16)]) if b.is_byte(n)
                   else b.id_to_piece(n).replace("▁", " ").encode() for n in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            out.append((doc_id, [], [], [], []))
            continue

        def spans(tokens):
            at, found = 0, []
            for token in tokens:
                found.append((at, at + len(token)))
                at += len(token)
            return found
        spans_a, spans_b = spans(bytes_a), spans(bytes_b)
        links, first = [], 0
        for i, (s, e) in enumerate(spans_a):
            while spans_b[first][1] <= s:
                first += 1
            j = first
            while j < len(spans_b) and spans_b[j][0] < e:
                links.append((ids_a[i], ids_b[j]))
                j += 1
        common = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, start = [], 0
        for end in common:
            groups.append(tuple([n for n, (s, e) in zip(ids, sp) if start <= s and e <= end]
                                for ids, sp in ((ids_a, spans_a), (ids_b, spans_b)))
                          if len(text) < 3000 else ())
            start = end
        out.append((doc_id, ids_a, ids_b, groups, links))
    held = Counter(pair for *_, links in out for pair in set(links))
    highest = defaultdict(int)
    for (x, _), n in held.items():
        highest[x] = max(highest[x], n)
    return sorted((
        doc_id, len(ids_a), len(ids_b), len(groups), len(links),
        sum(held[p] == highest[p[0]] for p in links), sum(held[p] for p in links),
        hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y))
                                for x, y in groups).encode()).hexdigest()
        if groups and groups[0] else "" if not groups else None)
        for doc_id, ids_a, ids_b, groups, links in out)


def rows_of(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect())


@pytest.mark.parametrize("limit", [ta.BROADCAST_BYTES, 0])
def test_equals_brute_force(documents, small, staging, limit):
    rows = list(enumerate(ODD))
    rows += [(100 + r.doc_id, r.text) for r in small("documents").collect()
             if len(r.text or "") < 3000][:60]
    rows += [(1000 + n, "the same text again") for n in range(5)]
    found = rows_of(ta.agreement(documents(rows), A, B, staging, limit))
    assert found == brute(rows)


def test_cases(documents, staging):
    rows = [(1, None), (2, ""), (3, LONG), (4, LONG_WORD), (5, "twice"), (6, "日本語" * 20_000)]
    docs = documents(rows).selectExpr("*", "text AS row", "doc_id AS pair")
    want = [r[:7] for r in brute(rows)]
    assert [r[:7] for r in rows_of(ta.agreement(docs, A, B, staging))] == want
    twice = documents([(5, "twice"), (5, "twice")])
    assert [r[4:7] for r in rows_of(ta.agreement(twice, A, B, staging))] == [
        (r[4], r[4], 2 * r[4]) for r in brute([(5, "twice")])] * 2
    assert ta.agreement(docs.limit(0), A, B, staging).count() == 0


def test_word_by_word_equals_whole_texts():
    pieces = ta.Pieces(B)
    assert pieces.by_word
    column = pa.array([" " + t for t in ODD] + ["", " " + LONG], pa.large_string())
    ids, first = pieces.encode(column)
    pieces.by_word = False
    whole, its = pieces.encode(column)
    assert ids.tolist() == whole.tolist() and first.tolist() == its.tolist()


def test_windows_change_nothing(monkeypatch):
    of = ta.tokenizers(A, B)
    column = pa.array([" " + t for t in ODD], pa.large_string())
    whole = ta.align(column, of)
    monkeypatch.setattr(ta, "WINDOW", 7)
    assert ta.align(column, of).digests == whole.digests
