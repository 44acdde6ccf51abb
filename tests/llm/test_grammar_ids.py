"""Ids in grammar-compressed files: against the tokenizer, and back to the same ids."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import AddedToken, Tokenizer

from viewstar.llm import bpe, grammar_ids as g
from viewstar.llm.queries import op1_grammar_ids
from llm_cases import LONG, LONG_WORD, SMALL, documents, small  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def encoded(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


PARTS = ["a", "B", "é", "ß", "1", "²", " ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "!",
         "…", "中", "😀", "́", "'S", "\r\n", "<|endoftext|>", "　", "don't"]


def test_pieces_equal_the_tokenizer(tokenizer):
    pick = random.Random(4)
    texts = [None, "", " ", "'", "''s", "don't's 'll", " 's", "a \n b", LONG_WORD[:5000]] + [
        "".join(pick.choice(PARTS) for _ in range(pick.randint(1, 25))) for _ in range(4000)]
    ids, first = bpe.PieceEncoder(PATH).encode(pa.array(texts))
    for n, text in enumerate(texts):
        assert ids[first[n]:first[n + 1]].tolist() == encoded(tokenizer, text), repr(text)


def test_forgotten_pieces_are_learned_again(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 20)
    encoder = bpe.PieceEncoder(PATH)
    for start in range(0, 200, 10):
        texts = [f"number {n} of many words" for n in range(start, start + 10)]
        ids, first = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [
            encoded(tokenizer, t) for t in texts]


DOCUMENTS = st.lists(st.lists(st.integers(0, 6), max_size=60), min_size=1, max_size=8)


@given(DOCUMENTS)
@settings(max_examples=150, deadline=None)
def test_round_trip_and_random_access(made):
    ids, first = g._with_end(np.array([i for d in made for i in d], np.uint32),
                             np.cumsum([0] + [len(d) for d in made]), g.END_ID)
    block = g.Block(g.pack(ids, first))
    got = [d.tolist() for d in block.documents()]
    assert got == [d + [g.END_ID] for d in made]
    for n, document in enumerate(got):
        size = len(document)
        for start, end in ((0, size), (size // 2, size), (1, min(3, size)), (size, size)):
            assert block.slice(n, start, end).tolist() == document[start:end]


@given(DOCUMENTS)
@settings(max_examples=150, deadline=None)
def test_pairs_sorted_at_once_or_after_a_look_give_one_block(made):
    ids, first = g._with_end(np.array([i for d in made * 3 for i in d], np.uint32),
                             np.cumsum([0] + [len(d) for d in made * 3]), g.END_ID)
    payloads = set()
    for few in (0, 1 << 16):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(g, "_FEW", few)
            payloads.add(g.pack(ids, first))
    assert len(payloads) == 1
    assert np.array_equal(np.concatenate(list(g.Block(payloads.pop()).documents())), ids)


def test_common_pieces_are_looked_up_without_a_search(tokenizer, monkeypatch):
    """Pieces met before are neither learned nor sorted among the known ones again."""
    encoder = bpe.PieceEncoder(PATH)
    texts = [f"word{n} is here" for n in range(50)]
    encoder.encode(pa.array(texts))
    asked = []
    find = encoder.table._find
    monkeypatch.setattr(encoder.table, "_find", lambda keys, *rest: (
        asked.append(len(keys)), find(keys, *rest))[1])
    ids, first = encoder.encode(pa.array(texts))
    assert asked == [0]
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [
        encoded(tokenizer, t) for t in texts]


def test_runs_and_repeats_compress():
    ids = np.array(([5] * 999 + [7, 8, 9] * 500) * 2, np.uint32)
    ids, first = g._with_end(ids, np.array([0, len(ids)]), g.END_ID)
    left, right, symbols, heads = g.compress(ids, first)
    assert len(symbols) < len(ids) / 20 and heads.tolist() == [0]
    # Every nonterminal is used, and each rule only uses symbols before it.
    numbers = np.arange(len(left)) + g.VOCABULARY
    assert (left < numbers).all() and (right < numbers).all()
    block = g.Block(g.pack(ids, first))
    assert np.array_equal(next(block.documents()), ids)
    assert block._every[block.symbols].sum() == len(ids)


def test_whole_query_equals_the_tokenizer(spark, small, tokenizer):
    got = {r["doc_id"]: r for r in op1_grammar_ids(spark, SMALL).collect()}
    start = 0
    for row in small("documents").orderBy("doc_id").collect():
        ids = encoded(tokenizer, row["text"]) + [g.END_ID]
        found = got.pop(row["doc_id"])
        assert (found["start"], found["n_tokens"]) == (start, len(ids))
        assert found["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert not got


def test_defined_cases(spark, documents, staging, tokenizer):
    rows = [(3, None), (1, ""), (2, LONG), (7, LONG_WORD), (5, "same"), (5, "same"),
            (None, "no id"), (-4, "a\nb")]
    frame = documents(rows).withColumnsRenamed({"lang": "shard", "source": "block"})
    path = staging.path("ids")
    g.write_ids(frame.repartition(3), path, PATH)
    got = g.read_documents(g.open_blocks(spark, path)).orderBy("start").collect()
    want, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = encoded(tokenizer, text) + [g.END_ID]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    empty = staging.path("none")
    g.write_ids(documents([]), empty, PATH)
    assert g.read_documents(g.open_blocks(spark, empty)).count() == 0
    with pytest.raises(ValueError):
        g.Block(b"something else")


def test_added_tokens_equal_the_tokenizer_as_it_is(spark, documents, staging, tmp_path):
    plain = Tokenizer.from_file(PATH)
    pick = random.Random(9)
    marker = "<|endoftext|>"
    texts = [None, "", marker, marker * 3, f"a{marker}b", f"a {marker}  b", f"{marker}'s", "<|endoftext|"]
    texts += ["".join(pick.choice([*PARTS, marker, marker]) for _ in range(pick.randint(1, 12)))
              for _ in range(1500)]
    ids, first = bpe.encoder(PATH).encode(pa.array(texts))
    for n, text in enumerate(texts):
        assert ids[first[n]:first[n + 1]].tolist() == encoded(plain, text), repr(text)
    assert encoded(plain, f"a{marker}b") == [64, 50256, 65]
    # The files hold the token, and the documents after it start where they should.
    path = staging.path("ids")
    g.write_ids(documents([(n, t) for n, t in enumerate(texts[:8])]).repartition(3), path, PATH)
    start = 0
    for row in g.read_documents(g.open_blocks(spark, path)).orderBy("doc_id").collect():
        want = encoded(plain, texts[row["doc_id"]]) + [g.END_ID]
        assert (row["start"], row["n_tokens"]) == (start, len(want))
        assert row["ids_crc32"] == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    # Overlapping tokens, found in one pass or in two, and one that takes the blanks before it.
    overlapping = ["<|end", "<|endoftext|>x"]
    for more in (overlapping, [AddedToken(t, normalized=False) for t in overlapping],
                 [AddedToken("[M]", lstrip=True, normalized=False)]):
        made = Tokenizer.from_file(PATH)
        made.add_tokens(more)
        made.save(str(tmp_path / "more.json"))
        own = [*texts[:200], "a  [M] b", "<|end<|endoftext|>x<|endoftext|>"]
        ids, first = bpe.TextEncoder(str(tmp_path / "more.json")).encode(pa.array(own))
        for n, text in enumerate(own):
            assert ids[first[n]:first[n + 1]].tolist() == encoded(made, text), repr(text)


def test_rounds_go_on_until_no_pair_is_frequent():
    pick = np.random.default_rng(3)
    passage = pick.integers(0, 50_000, 3000)
    for ids in (np.tile(passage, 40), np.append(pick.zipf(1.3, 60_000) % 900, [4] * 999)):
        ids, first = g._with_end(ids.astype(np.uint32), np.array([0, 777, len(ids)]), g.END_ID)
        _, _, symbols, heads = g.compress(ids, first)
        pairs = {}
        for place, pair in enumerate(zip(symbols.tolist(), symbols[1:].tolist())):
            if place + 1 not in heads:
                pairs[pair] = pairs.get(pair, 0) + 1
        assert max(pairs.values(), default=0) < g.MIN_COUNT
        assert np.array_equal(np.concatenate(list(g.Block(g.pack(ids, first)).documents())), ids)
    # A passage is one symbol in the end, and its copies share it.
    ids, first = g._with_end(np.tile(passage, 40).astype(np.uint32), np.array([0, 120_000]), 2)
    assert len(g.compress(ids, first)[2]) < 40


def test_symbols_of_more_than_three_bytes():
    ids = np.array([7, 8] * 6 + [9], np.uint32)
    big = (1 << 24) + 5
    for vocabulary, magic in ((100, g.MAGIC), (big, g.WIDE)):
        payload = g.pack(ids, np.array([0, 6, 13]), vocabulary)
        assert payload[:4] == magic
        block = g.Block(payload)
        assert len(block.left) and [d.tolist() for d in block.documents()] == [
            ids[:6].tolist(), ids[6:].tolist()]


def test_order_of_files_is_kept(spark, tmp_path):
    """Small files that share tasks, and files cut over several tasks."""
    rows = [(n * 37 % 1000, f"text {n} " * (n % 9 * 300)) for n in range(1000)]
    for number in range(4):
        spark.createDataFrame(rows[number * 250:number * 250 + 250], "doc_id long, text string"
                              ).coalesce(1).write.option("parquet.block.size", 20_000).mode(
            "append").parquet(str(tmp_path / f"p{number}"))
    import os
    import shutil
    os.mkdir(tmp_path / "all")
    for number in range(4):
        name, = [f for f in os.listdir(tmp_path / f"p{number}") if f.endswith(".parquet")]
        shutil.copy(tmp_path / f"p{number}" / name, tmp_path / "all" / f"part-{number:05d}.parquet")
    for size in ("128m", "30k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            path = str(tmp_path / f"ids{size}")
            g.write_ids(spark.read.parquet(str(tmp_path / "all")), path, PATH,
                        in_file_order=True)
            blocks = g.open_blocks(spark, path)
            got = g.read_documents(blocks).orderBy("start").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r.doc_id for r in got] == [d for d, _ in rows]
        assert got[-1].start == sum(r.n_tokens for r in got[:-1])
        shards = blocks.select("shard").distinct().count()
        assert shards == 4 if size == "128m" else shards > 4
