"""Near duplicates against all pairs of shingle sets."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from viewstar.llm import graph, near_duplicates as nd
from viewstar.llm.graph import components
from llm_cases import LONG, LONG_WORD, documents, small  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(text or "")
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    """{row number: (class, copy, links)} by comparing all pairs of different texts."""
    texts = sorted({t or "" for _, t in rows})
    copy = {t: min(d for d, x in rows if (x or "") == t) for t in texts}
    sets = {t: shingle_set(t) for t in texts}
    parent, links = {t: t for t in texts}, Counter()

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for a, b in combinations(texts, 2):
        both, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if either and 5 * both >= 4 * either:
            links[a] += 1
            links[b] += 1
            parent[root(a)] = root(b)
    least = {}
    for t in texts:
        least[root(t)] = min(least.get(root(t), copy[t]), copy[t])
    return sorted(((d, least[root(x or "")], copy[x or ""], links[x or ""]) for d, x in rows),
                  key=str)


def found(docs, staging):
    frame = nd.near_duplicates(docs, staging)
    return sorted(((r["doc_id"], r["class_id"], r["copy_id"], r["n_links"])
                   for r in frame.collect()), key=str)


def variants(seed, count, words=120, changes=2):
    pick = random.Random(seed)
    base = [f"v{seed}w{pick.randrange(10**6)}" for _ in range(words)]
    for _ in range(count):
        text = list(base)
        for _ in range(pick.randint(0, changes)):
            text[pick.randrange(words)] = f"new{pick.randrange(10**9)}"
        yield " ".join(text)


@pytest.mark.parametrize("block", [256, 4])
def test_groups_equal_all_pairs(documents, staging, monkeypatch, block):
    # Blocks of four cut every group, as blocks of 256 cut groups of thousands.
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "PACK", 50)
    texts = [t for seed in range(12) for t in variants(seed, 3 + seed, changes=1 + seed % 6)]
    texts += texts[:20] + ["", " ", None, "", "one two", "one two", "one  two", "a b c d e"]
    rows = list(enumerate(texts))
    assert found(documents(rows), staging) == brute_force(rows)


def test_small_table_equals_all_pairs(small, staging):
    rows = [(r["doc_id"], r["text"]) for r in small("documents").collect()]
    assert found(small("documents"), staging) == brute_force(rows)


def test_large_group_of_near_copies(documents, staging):
    rows = list(enumerate(variants(99, 300, words=200, changes=2)))
    got = found(documents(rows), staging)
    assert got == brute_force(rows)
    assert max(r[3] for r in got) > 150


def test_defined_cases(documents, staging):
    rows = [(1, LONG), (2, LONG + " end"), (3, LONG_WORD), (4, LONG_WORD), (5, None), (6, "")]
    assert found(documents(rows), staging) == brute_force(rows)
    assert nd.near_duplicates(documents([]), staging).count() == 0
    twice = documents([(None, "x y"), (None, "x y"), (7, "x y"), (7, "x y"), (None, "z")])
    assert found(twice, staging) == sorted([
        (None, 7, 7, 0), (None, 7, 7, 0), (7, 7, 7, 0), (7, 7, 7, 0), (None, None, None, 0)],
        key=str)


def test_keep_one_per_class(documents, staging):
    near = list(variants(5, 6, changes=1))
    rows = [(10 + n, t) for n, t in enumerate(near)] + [
        (1, "lone text here"), (1, "lone text here"), (1, "another text"), (None, "x"),
        (None, "y"), (30, None), (31, "")]
    frame = documents(rows).withColumnsRenamed({"lang": "_kept", "n_chars": "node"})
    kept = nd.keep_one(frame, staging)
    assert kept.columns == frame.columns
    expected = [(1, "another text"), (1, "lone text here"), (10, near[0]), (30, None),
                (None, "x"), (None, "y")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        expected, key=str)
    assert nd.keep_one(documents([]), staging).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    least = nd.least_agreement()
    assert len(least) == nd.HASHES // nd.STEP and least == sorted(least)
    # A pair at the threshold falls below the least agreement of a step with a tiny chance.
    rng = np.random.default_rng(1)
    draws = rng.binomial(1, nd.THRESHOLD, (200_000, nd.HASHES)).cumsum(axis=1)
    lost = np.zeros(len(draws), bool)
    for step, few in enumerate(least):
        lost |= draws[:, (step + 1) * nd.STEP - 1] < few
    assert lost.mean() < 1e-4


def test_minhash_agreement_is_near_the_similarity():
    rng = np.random.default_rng(2)
    agreed = []
    for _ in range(60):
        pool = rng.integers(0, 2**63, 300, dtype=np.uint64)
        first = nd.Words(np.concatenate((pool[:270], pool[30:])), np.array([0, 270, 540]))
        one, two = nd.minhashes(first)
        agreed.append((one == two).mean())
    assert abs(np.mean(agreed) - 0.8) < 0.03


def test_components_of_a_path_and_a_star(spark, staging):
    path = [(n, n + 1) for n in range(40)]
    star = [(100, n) for n in range(101, 160)]
    edges = spark.createDataFrame(path + star + [(7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges, staging).collect()}
    assert got == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 160)}


@pytest.mark.parametrize("share", [1, 6, 10_000])
def test_components_with_hubs_against_union_find(spark, staging, monkeypatch, share):
    monkeypatch.setattr(graph, "HUB_SHARE", share)
    rng = random.Random(share)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(190)]
    edges += [(500, n) for n in range(501, 620)] + [(n, 700) for n in range(610, 700)]
    parent = {n: n for edge in edges for n in edge}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    frame = spark.createDataFrame(edges + edges[:5], "a long, b long")
    got = {r["node"]: r["root"] for r in components(frame, staging).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: root(n) for n in linked}


def test_components_of_nothing(spark, staging):
    edges = spark.createDataFrame([(3, 3), (None, 4), (4, None)], "a long, b long")
    assert components(edges, staging).collect() == []
