"""The pipeline: stages as stated, and the whole run against brute force in Python."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from test_decontamination import brute_force as overlaps, tokens
from test_near_duplicates import brute_force as classes
from viewstar.llm import mixing, quality_rules as rules
from llm_cases import SMALL, documents, small  # noqa: F401


def test_every_query_is_registered_and_guarded():
    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert "pipeline" in names and set(contract.oracle_sql()) <= set(names)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "source_mix", "grammar_ids"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_the_columns_of_documents(spark, small):
    docs = small("documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == small("documents").columns


def test_whole_run_against_brute_force(spark, small):
    kept = rules.judged(small("documents"), "q").where("q.kept").select(
        "doc_id", "text", "source").collect()
    sources = {r["doc_id"]: r["source"] for r in kept}
    rows = [(r["doc_id"], r["text"]) for r in kept]
    text = dict(rows)
    rows = [(d, text[d]) for d, least, _, _ in classes(rows) if d == least]
    items = [(r["item_id"], r["text"]) for r in small("benchmark").collect()]

    def sixes(t):
        w = tokens(t)
        return {tuple(w[i:i + 6]) for i in range(len(w) - 5)}

    bench = {i: sixes(t) for i, t in items}
    clean = [(d, t) for d, t in rows if not any(
        sixes(t) & bench[i] and overlaps([(d, t)], [(i, x)]) for i, x in items)]
    assert len(clean) < len(rows)
    frame = spark.createDataFrame([(d, t, sources[d]) for d, t in clean],
                                  "doc_id long, text string, source string")
    whole = [r["doc_id"] for r in mixing.copies(frame).collect()]
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    want, start = [], 0
    # The files hold the order of the curriculum.
    assert whole != sorted(whole)
    for doc_id in whole:
        ids = encode(text[doc_id], add_special_tokens=False).ids + [2]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = contract.queries()["pipeline"](spark, SMALL).orderBy("start").collect()
    assert [tuple(r) for r in got] == want


def test_nulls_ties_and_clashing_columns_pass_all_stages(spark, tmp_path):
    text = " ".join(f"word{n} of the" for n in range(40))
    rows = [(1, text, "en", None, 1), (1, text, "en", None, 1), (None, text + " more", None, "s", 2),
            (2, None, None, None, None), (3, "", "en", "s", 0), (4, text + " and on", "en", "s", 3)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "lang AS file", "source AS row", "n_chars AS _kept", "text AS shard")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    got = docs.collect()
    assert all(r["n_tokens"] >= 1 for r in got)
    assert sorted(r["start"] for r in got) == [
        sum(r["n_tokens"] for r in got if r["start"] < s) for s in sorted(r["start"] for r in got)]


def test_an_empty_table_passes_all_stages(spark, documents):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
