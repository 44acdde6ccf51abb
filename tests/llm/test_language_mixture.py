import numpy as np
import pyarrow as pa

from viewstar.llm import language_mixture as lm
from llm_cases import LONG, LONG_WORD, SMALL, documents, small  # noqa: F401


def model_of(spark, rows):
    return lm.train(spark.createDataFrame(rows, "lang string, text string"))


def brute_words(text):
    """Words of a text as a plain loop sees them: (letters) with the two before each."""
    import unicodedata
    out, word = [], ""
    for c in unicodedata.normalize("NFC", text) + " ":
        if unicodedata.category(c)[0] in "LM":
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            if any(x.isalpha() for x in word):
                out.append(word)
            word = ""
    return out


def test_words_are_those_of_a_plain_loop():
    texts = ["Hello, wörld! 12 x", "", None, "éa ́ b", "a" * 70 + " b", "… 123", "ДА да"]
    found = lm.letters(pa.array(texts))
    for number, text in enumerate(texts):
        pieces = sum(-(-len(w) // lm.WORD) for w in brute_words(text or ""))
        assert (found.of == number).sum() == pieces, text


def test_likelihood_is_the_product_over_letters(spark):
    model = model_of(spark, [("x", "abc abd"), ("y", "zzz")])
    found = lm.letters(pa.array(["abz"]))
    likely = lm.word_likelihoods(found, model)
    logs = [sum(model.three[k][b] for b in found.three) - sum(model.two[k][b] for b in found.two)
            for k in range(2)]
    assert len(found.three) == 4  # three letters and the end of the word
    assert np.allclose(np.log(likely[0, 0] / likely[0, 1]), logs[0] - logs[1], atol=1e-3)


def brute_em(likely, active, rounds=2000):
    share = np.where(active, 1.0, 0)
    share /= share.sum()
    for _ in range(rounds):
        joint = likely * share
        share = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
    return share, np.log((likely * share).sum(axis=1)).sum()


def test_proportions_equal_plain_em():
    random = np.random.default_rng(3)
    # Words that mostly belong to one language, so that EM comes near its end in few rounds.
    likely = np.full((60, 3), 0.02) + np.eye(3)[random.choice(3, 60, p=[0.5, 0.3, 0.2])]
    likely = (likely * random.uniform(0.7, 1, likely.shape)).astype(np.float32)
    of = np.repeat([0, 1], 30)
    share, total = lm.proportions(likely, of, np.ones((2, 3), bool), np.full((2, 3), 1 / 3))
    for document in range(2):
        want, want_total = brute_em(likely[of == document].astype(float), np.ones(3, bool))
        assert np.allclose(share[document], want, atol=0.02)
        assert abs(total[document] - want_total) < 0.05


def test_set_of_least_penalised_likelihood():
    """With words that belong plainly to one language the set is what all subsets give."""
    import itertools
    likely = np.full((50, 4), 1e-6, np.float32)
    likely[:30, 1] = 1
    likely[30:, 3] = 1
    likely[5, 2] = 0.9  # one word that another language explains nearly as well
    share = lm.language_sets(likely, np.zeros(50, int), 1)[0]
    best = max((brute_em(likely.astype(float), np.isin(range(4), chosen), 50)[1]
                - 0.5 * np.log(50) * (len(chosen) - 1), chosen)
               for n in range(1, 5) for chosen in itertools.combinations(range(4), n))[1]
    assert set(np.flatnonzero(share)) == set(best) == {1, 3}
    assert np.allclose(share[[1, 3]], [0.6, 0.4], atol=0.01)


def test_held_out_accuracy(spark, small):
    docs = small("documents")
    model = lm.train(lm.sample(docs))
    found = lm.predicted(docs, model).join(docs, "doc_id").where(
        lm.held_out("doc_id")).where("lang is not null").select("lang", "lang_pred").collect()
    assert np.mean([r.lang == r.lang_pred for r in found if r.lang_pred != "und"]) > 0.95


def test_mixture_of_two(spark, small):
    docs = small("documents")
    model = lm.train(lm.sample(docs))
    by = {r.lang: r.text for r in docs.where("length(text) between 1500 and 6000").collect()}
    half = {lang: " ".join(by[lang].split()[:150]) for lang in ("en", "de")}
    mixed = spark.createDataFrame([(1, half["en"] + "\n" + half["de"])], "doc_id long, text string")
    shares = dict(lm.predicted(mixed, model).first().shares)
    assert abs(shares.get("en", 0) - 0.5) < 0.2 and abs(shares.get("de", 0) - 0.5) < 0.2


def test_cases(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "12 34 !"), (4, "der hund"), (4, "der hund"),
                      (None, "the dog"), (5, LONG), (6, LONG_WORD), (7, "漢字")])
    model = model_of(spark, [("de", "der hund und die katze"), ("en", "the dog and the cat")])
    rows = {(r.doc_id, r.lang_pred, round(r.score, 6)) for r in
            lm.predicted(docs.withColumn("shares", docs.text), model).collect()}
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "de", 1.0)} <= rows
    assert (None, "en", 1.0) in rows and len(rows) == 8
    assert lm.predicted(docs.limit(0), model).count() == 0
    nothing = lm.train(lm.sample(docs.limit(0)))
    assert {r.lang_pred for r in lm.predicted(docs, nothing).collect()} == {"und"}


def test_sample_is_bounded_and_leaves_the_held_out(spark):
    rows = [(n, f"text {n}", "en" if n % 3 else None) for n in range(300)]
    docs = spark.createDataFrame(rows + [(1, "again", "en")], "doc_id long, text string, lang string")
    chosen = lm.sample(docs, rows=20)
    assert 12 <= chosen.count() <= 21
    assert lm.sample(docs, rows=500).count() == docs.where("lang is not null").where(
        ~lm.held_out("doc_id")).count()
    texts = {r.text for r in lm.sample(docs).collect()}
    held = {r.text for r in docs.where(lm.held_out("doc_id")).collect()}
    assert texts and not texts & held
