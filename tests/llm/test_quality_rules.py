"""Quality rules: defined cases, and the whole table against SQL."""

import compare

from viewstar.llm import quality_rules as rules
from llm_cases import LONG, LONG_WORD, SMALL, documents  # noqa: F401

CLEAN = " ".join(f"{w}{i} of the n{i}" for i, w in enumerate(["work", "plan", "text"] * 10))

def judged(documents, rows):
    frame = rules.judged(documents(rows), "q").select("doc_id", "q.*")
    return {row["doc_id"]: row.asDict() for row in frame.collect()}

def test_counts_of_a_small_text(documents):
    got = judged(documents, [(1, "a b c\na b c\n\na  b c\n#x $")])[1]
    assert (got["n_words"], got["word_chars"], got["n_symbols"]) == (11, 12, 2)
    # "a b c" twice equal; the third such line differs by a blank.
    assert got["n_dup_lines"] == 1
    assert got["n_repeat_words"] == 9
    assert got["base_failed"] and not got["kept"]

def test_defined_cases(documents):
    got = judged(documents, [
        (1, None), (2, ""), (3, " \n\t"), (4, LONG), (5, LONG_WORD), (6, CLEAN), (6, CLEAN),
        (None, CLEAN), (8, "the " * 60)])
    assert all(got[k]["n_words"] == 0 and got[k]["base_failed"] for k in (1, 2, 3))
    assert got[4]["n_words"] == 60_000 and not got[4]["base_failed"]
    assert got[5]["n_words"] == 1 and got[5]["word_chars"] == 300_000
    assert got[6]["kept"] and got[None]["kept"]
    assert got[8]["n_repeat_words"] == 60 and got[8]["base_failed"]

def test_overlapping_repeats_count_each_word_once(documents):
    got = judged(documents, [(1, "x x x x"), (2, "p q r s p q r t"), (3, "a b c")])
    assert [got[k]["n_repeat_words"] for k in (1, 2, 3)] == [4, 6, 0]

def test_each_rule_rejects(documents):
    words = CLEAN.split()
    got = judged(documents, [
        (1, CLEAN), (2, " ".join(w + "***" for w in words)),
        (3, " ".join(f"n{i}" for i in range(80))),
        (4, " ".join(f"verylongwordwithoutend{i}" if i % 3 else "the" for i in range(80)))])
    assert [got[k]["kept"] for k in (1, 2, 3, 4)] == [True, False, False, False]
    assert not any(got[k]["base_failed"] for k in (1, 2, 3, 4))

def test_clashing_columns_and_empty_tables(documents):
    frame = documents([(1, CLEAN), (2, "no")])
    frame = frame.withColumnsRenamed({"lang": "_quality", "n_chars": "n_words"}).withColumn(
        "a.b", frame["doc_id"])
    kept = rules.keep_good(frame)
    assert kept.columns == frame.columns
    assert [row["doc_id"] for row in kept.collect()] == [1]
    assert rules.keep_good(documents([])).count() == 0

def test_one_projection_without_python(documents, plan):
    text = plan(rules.judged(documents([(1, "a")]), "q"))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text

def test_whole_table_equals_sql(spark):
    assert compare.compare(spark, compare.connect(SMALL), SMALL, "op7_quality_rules") == ""
