import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from viewstar.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The contract, word by word, over (conv_id, turn, role, text) rows without equal turns."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        full[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        yield path
        for child in children[path]:
            yield from below(child)

    out = set()
    for path, convs in members.items():
        nodes = list(below(path))
        ends = ",".join(str(c) for c in sorted(convs) if len(full[c]) == len(path))
        out.add((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
                 len(children[path]), sum(not children[n] for n in nodes),
                 sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in nodes if n),
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.fixture
def found(spark, staging):
    def run(rows, block=pt.BLOCK):
        frame = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
        stored = staging.table(pt.sequences(frame), "sequences")
        nodes = pt.trie(pt.rebuilt(stored), staging, block).select(*pt.COLUMNS).collect()
        assert len(set(map(tuple, nodes))) == len(nodes)
        return set(map(tuple, nodes))
    return run


def made(seed, conversations, words, longest):
    """Conversations of few distinct turns, so that many share a beginning."""
    draw = random.Random(seed)
    rows = []
    for c in range(conversations):
        for turn in range(draw.randint(1, longest)):
            rows.append((c, turn, draw.choice(["user", None]),
                         "wü" * draw.randint(0, words)))
    return rows


@pytest.mark.parametrize("block", [1, 2, 3, 7, 512])
def test_equals_brute_force(found, block):
    rows = made(block, 60, 1, 12)
    assert found(rows, block) == brute(rows)


def test_copies_over_many_blocks(found):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 200) for t in range(3)]
    rows += [(c, t, "user", f"turn {t}") for c in range(200, 240) for t in range(14)]
    assert found(rows, 9) == brute(rows)


def test_cases(found, spark):
    rows = [(0, None, None, None), (0, 3, "user", "b"), (0, 1, "user", ""),
            (7, 0, "x" * 70_000, "y" * 100_000), (-3, 0, "user", "a"), (-5, 1, "u", "v"),
            (11, 0, "user", "gone")]
    # 11 has no conversation 10, and its head is longer than itself: a member of the root alone.
    assert zlib.crc32(b"11") % 9 >= 1
    got = found(rows)
    positive = [r for r in rows if r[0] >= 0]
    assert found(positive) == brute(positive)
    assert {n[3] for n in got if n[1] == 0} == {5}
    assert found(rows + [(None, 0, "user", "a")]) == got
    assert found([]) == set()
    again = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "text AS key", "turn AS block")
    assert found(again) == got
    # A repeated row is one more turn.
    depth = max(n[1] for n in found([(0, 0, "u", "a"), (0, 0, "u", "a")]))
    assert depth == 2


def test_long_conversation(found):
    rows = [(c, t, "user", f"t{t}") for c in (0, 5) for t in range(3000)]
    rows += [(10, t, "user", f"t{t}" if t < 2000 else "x") for t in range(2500)]
    got = {(n[1]): n for n in found(rows, 2) if n[0] == 0}
    assert len(found(rows, 2)) == 3001 + 500
    assert got[2000][3:6] == (3, 2, 2) and got[2001][3:5] == (2, 1) and got[3000][3:5] == (2, 0)
    assert got[3000][7] == hashlib.sha256(b"0,5").hexdigest()


def test_common_turns():
    draw = np.random.default_rng(1)
    turns = [draw.bytes(16) for _ in range(5)]
    for n in range(6):
        for m in range(6):
            assert pt.common_turns(b"".join(turns[:n]), b"".join(turns[:m])) == min(n, m)
    assert pt.common_turns(turns[0] + turns[1][:15] + b"?", turns[0] + turns[1]) == 1
