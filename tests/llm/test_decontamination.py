"""Overlaps with test items against comparing every item at every place."""

import random

import pytest

from viewstar.llm import decontamination as d
from viewstar.llm.queries import op10_decontamination
from llm_cases import LONG, LONG_WORD, SMALL, documents, small  # noqa: F401

ITEM = "item_id long, text string"


def tokens(text):
    return d.TOKEN.findall((text or "").lower())


def brute_force(docs, items):
    """{(doc, item): most equal tokens} over every place, extended as the operator does."""
    found = {}
    for doc_id, text in docs:
        words = tokens(text)
        for item_id, item in items:
            want = tokens(item)
            if not want:
                continue
            for shift in range(-len(want) + 1, len(words)):
                low, high = max(0, -shift), min(len(want), len(words) - shift)
                equal = [want[i] == words[i + shift] for i in range(low, high)]
                # Any run of equal tokens may be where a mask finds the pair.
                for at, same in enumerate(equal):
                    if not same:
                        continue
                    left, right = d._extended(d.np.array(equal), at)
                    matches = sum(equal[left:right])
                    enough = min(d.MIN_MATCHES, -(-len(want) * 4 // 5))
                    if matches >= enough and matches >= d.MIN_SHARE * (right - left):
                        key = (doc_id, item_id)
                        found[key] = max(found.get(key, 0), matches)
    return found


def found(frame):
    rows = frame.collect()
    assert len({(r["doc_id"], r["item_id"]) for r in rows}) == len(rows)
    return {(r["doc_id"], r["item_id"]): r["n_matches"] for r in rows}


def made(seed, items, docs):
    pick = random.Random(seed)
    common = ["the", "of", "and", "to", "a"]

    def prose(n):
        return [pick.choice(common) if pick.random() < 0.4 else f"w{pick.randrange(10**6)}"
                for _ in range(n)]

    bench = [(n, prose(pick.randint(15, 50))) for n in range(items)]
    rows = []
    for n in range(docs):
        text = prose(pick.randint(0, 80))
        if n % 2:
            _, passage = pick.choice(bench)
            passage = list(passage)
            for _ in range(pick.randint(0, len(passage) // 8)):
                passage[pick.randrange(len(passage))] = f"new{pick.randrange(10**6)}"
            text += passage + prose(20)
        rows.append((n, " ".join(text)))
    return rows, [(n, " ".join(w).capitalize() + ".") for n, w in bench]


def test_substituted_passages(documents, spark):
    rows, items = made(1, 12, 120)
    want = brute_force(rows, items)
    got = found(d.overlaps(documents(rows), spark.createDataFrame(items, ITEM)))
    # The same pairs; growing from another place may reach a few tokens further.
    assert got.keys() == want.keys() and len(got) >= 58
    assert all(want[pair] - 3 <= matches <= want[pair] for pair, matches in got.items())


def test_blocks_of_items_give_the_same(documents, spark, monkeypatch):
    rows, items = made(2, 10, 60)
    bench = spark.createDataFrame(items, ITEM)
    whole = found(d.overlaps(documents(rows), bench))
    monkeypatch.setattr(d, "BLOCK_TOKENS", 60)
    assert found(d.overlaps(documents(rows), bench)) == whole
    kept = {r["doc_id"] for r in d.clean(documents(rows), bench).collect()}
    assert kept == {n for n, _ in rows} - {n for n, _ in whole}


@pytest.mark.parametrize("changes", [1, 2])
def test_every_pair_of_substitutions_in_a_short_item(changes):
    from itertools import combinations
    for places in combinations(range(d.MIN_MATCHES), changes):
        assert any(all(start + p not in places for p in mask) for mask in d.MASKS
                   for start in range(d.MIN_MATCHES - mask[-1]))


def test_small_table(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in small("documents").collect()]
    items = [(r["item_id"], r["text"]) for r in small("benchmark").collect()]
    # Every place of all pairs is too much here: pairs that share six tokens in a row.
    def runs(text):
        words = tokens(text)
        return {tuple(words[i:i + 6]) for i in range(len(words) - 5)}
    by_item = {i: runs(t) for i, t in items}
    some = {}
    for doc_id, text in docs:
        own = runs(text)
        for item_id, item in items:
            if own & by_item[item_id]:
                some |= brute_force([(doc_id, text)], [(item_id, item)])
    got = found(op10_decontamination(spark, SMALL))
    assert some.keys() <= got.keys()
    for doc_id, item_id in got:
        pair = [(x, t) for x, t in docs if x == doc_id], [(x, t) for x, t in items if x == item_id]
        assert (doc_id, item_id) in brute_force(*pair)


def test_case_and_punctuation_do_not_matter(documents, spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi."
    changed = item.upper().replace(" ", ", ").replace("IOTA", "SWAPPED")
    got = found(d.overlaps(documents([(1, f"x {changed} y"), (2, "alpha beta gamma delta")]),
                           spark.createDataFrame([(9, item)], ITEM)))
    assert got == {(1, 9): 13}


def test_short_items_and_defined_cases(documents, spark):
    items = [(1, "one two three"), (2, None), (3, "..."), (None, "red green blue grey pink"),
             (5, "one two three"), (6, LONG)]
    rows = [(1, "zero one two three four"), (2, None), (3, ""), (4, LONG), (5, LONG_WORD),
            (6, "red green blue grey pink"), (6, "red green blue grey pink"), (None, "one two three")]
    bench = spark.createDataFrame(items, ITEM)
    frame = documents(rows).withColumnsRenamed({"lang": "item_id", "source": "n_matches"})
    got = sorted((str(r["doc_id"]), str(r["item_id"])) for r in d.overlaps(frame, bench).collect())
    assert got == [("1", "1"), ("1", "5"), ("4", "6"), ("6", "None"), ("6", "None"),
                   ("None", "1"), ("None", "5")]
    kept = d.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 5]
    none = spark.createDataFrame([], ITEM)
    assert d.overlaps(frame, none).count() == 0 and d.clean(frame, none).count() == len(rows)
    assert d.overlaps(documents([]), bench).count() == d.clean(documents([]), bench).count() == 0


def best_of_all_stretches(equal, enough):
    """Most equal tokens of a passing stretch, by trying every stretch; 0 without one."""
    best = 0
    for left in range(len(equal)):
        for right in range(left + 1, len(equal) + 1):
            matches = sum(equal[left:right])
            if matches >= enough and 5 * matches >= 4 * (right - left):
                best = max(best, matches)
    return best


def test_best_stretch_equals_trying_all():
    pick = random.Random(5)
    for _ in range(600):
        share = pick.choice([0.3, 0.6, 0.75, 0.8, 0.9])
        equal = [pick.random() < share for _ in range(pick.randint(0, 45))]
        enough = pick.choice([1, 4, 12, 13])
        got = d._best_stretch(d.np.array(equal, bool), enough)
        assert (got[0] if got else 0) == best_of_all_stretches(equal, enough)
        if got:
            matches, left, right = got
            assert sum(equal[left:right]) == matches and equal[left] and equal[right - 1]
            assert 5 * matches >= 4 * (right - left)


def changed(item, places):
    return " ".join(f"new{n}" if n in places else w for n, w in enumerate(item.split()))


def test_changes_near_the_ends_and_weaker_ground_hide_nothing(documents, spark):
    short = " ".join(f"a{n}" for n in range(16))
    long = " ".join(f"b{n}" for n in range(40))
    # 14 of 16; 13 of 16; the first 16 hold 13 and the rest two in three, 29 of 40 in all.
    rows = [(1, "x " + changed(short, {1, 14}) + " y"), (2, changed(short, {1, 7, 14})),
            (3, changed(long, {1, 8, 14, *range(17, 40, 3)})), (4, changed(short, {1, 5, 9, 13}))]
    bench = spark.createDataFrame([(1, short), (2, long)], ITEM)
    got = found(d.overlaps(documents(rows), bench))
    assert got.keys() == {(1, 1), (2, 1), (3, 2)}
    assert got[1, 1] == 14 and got[2, 1] == 13 and got[3, 2] >= 13
    assert [r["doc_id"] for r in d.clean(documents(rows), bench).collect()] == [4]


def hidden(masks, size, changes):
    """Ways to substitute so many of ``size`` tokens that no mask finds."""
    from itertools import combinations
    held = [sum(1 << start + p for p in mask) for mask in masks
            for start in range(size - mask[-1])]
    for places in combinations(range(size), changes):
        gone = sum(1 << p for p in places)
        if all(mask & gone for mask in held):
            yield places


@pytest.mark.parametrize("size", range(1, 21))
def test_no_lawful_substitution_hides_from_the_masks(size):
    enough = min(d.MIN_MATCHES, -(-size * 4 // 5))
    changes = size - enough if size < 16 else size // 5
    assert not list(hidden(d.SHORT_MASKS.get(size, d.MASKS), size, changes))


def test_no_longer_stretch_hides_from_the_masks():
    # Fewest substitutions that hide a stretch, by its last places (a bit set: substituted).
    span = max(mask[-1] for mask in d.MASKS)
    windows = d.np.arange(2 << span)
    free = d.np.ones(len(windows), bool)
    for mask in d.MASKS:
        free &= (windows & sum(1 << mask[-1] - p for p in mask)) != 0
    fewest = d.np.full(1 << span, 10**6)
    fewest[-1] = 0
    for size in range(1, 1001):
        after = d.np.where(free, d.np.repeat(fewest, 2) + windows % 2, 10**6)
        fewest = d.np.minimum(after[:1 << span], after[1 << span:])
        assert size < 16 or fewest.min() > size // 5


def test_all_overlaps_of_any_size_are_found():
    pick = random.Random(8)
    seen = 0
    for n in range(1500):
        item = [f"i{k}" for k in range(pick.randint(1, 24))]
        text = [w if pick.random() < 0.82 else "new" for w in item]
        text = ["x"] * pick.randint(0, 3) + text[pick.choice([0, 0, 1]):] + ["y"]
        equal = max(([a == b for a, b in zip(item[max(0, -k):], text[max(0, k):])]
                     for k in range(-2, 4)), key=sum)
        best = best_of_all_stretches(equal, min(d.MIN_MATCHES, -(-len(item) * 4 // 5)))
        block = d.Block([7], [" ".join(item)])
        words = d._tokens(d.pa.array([" ".join(text)]))
        got = [row[2] for row in d._overlaps(block, words.words, words.first)]
        assert got == ([best] if best else [])
        seen += bool(best)
    assert seen > 300


def test_repeated_tokens_take_little_memory_and_time(spark):
    """One token over and over, in text and item: a hit per diagonal, not per pair."""
    import time
    import tracemalloc
    block = d.Block([1, 2], ["a " * 500, "b c " * 200])
    tracemalloc.start()
    begun = time.time()
    for text, want in (("a " * 20_000, 1), ("b c " * 10_000, 2), ("x " + "a " * 10 + "y " * 9, 0)):
        words = d._tokens(d.pa.array([text]))
        got = [(block.item_ids[i], m) for _, i, m, *_ in d._overlaps(block, words.words, words.first)]
        assert got == ([(want, 500 if want == 1 else 400)] if want else [])
    assert tracemalloc.get_traced_memory()[1] < 60 << 20 and time.time() - begun < 60
    tracemalloc.stop()


def test_every_diagonal_that_shares_a_window_is_found():
    """The shortened list of hits names the diagonals of all hits, and no others."""
    draw = random.Random(4)
    for _ in range(60):
        items = [" ".join(draw.choices("abc", k=draw.randint(1, 30))) for _ in range(3)]
        docs = [" ".join(draw.choices("abc", k=draw.randint(0, 60))) for _ in range(4)]
        block = d.Block([0, 1, 2], items)
        words = d._tokens(d.pa.array(docs))
        got = {tuple(hit) for part in d._hits(block, words.words, words.first)
               for hit in part.T.tolist()}
        want = set()
        for i in range(3):
            start, end = block.first[i], block.first[i + 1]
            for mask in d.SHORT_MASKS.get(end - start, d.MASKS):
                for doc in range(4):
                    low, high = words.first[doc], words.first[doc + 1]
                    for q in range(low, high - mask[-1]):
                        for p in range(start, end - mask[-1]):
                            if all(words.words[q + m] == block.tokens[p + m] for m in mask):
                                want.add((doc, i, q - p))
        assert got == want


def test_slices_change_nothing(monkeypatch):
    draw = random.Random(5)
    block = d.Block([0, 1], [" ".join(draw.choices("ab", k=40)) for _ in range(2)])
    words = d._tokens(d.pa.array([" ".join(draw.choices("ab", k=300)) for _ in range(5)]))
    whole = sorted(d._overlaps(block, words.words, words.first))
    monkeypatch.setattr(d, "SLICE", 7)
    assert sorted(d._overlaps(block, words.words, words.first)) == whole
