import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from shopflow.llm import prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string, depth int, id string, parent string"


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]  # the remainder has the sign of the id, as in SQL
    members = defaultdict(list)
    for c, t in rebuilt.items():
        for d in range(len(t) + 1):
            members[tuple(t[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = own + sum(saved[k] for k in children[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def made(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", "y") for r in rows], COLUMNS)


def order(rows):
    return sorted(map(tuple, rows), key=str)


def corpus(seed, n=60):
    rng, rows = random.Random(seed), []
    for c in range(0, n):
        if rng.random() < 0.15:
            continue
        for t in range(rng.choice([1, 2, 3, 5, 8, 12])):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t > 2 else "user", rng.choice(["hi", "é日", "what?", ""]) if t < 6 else str(rng.random())))
    return rows


@pytest.mark.parametrize("task_rows", [7, 200_000])
def test_against_plain_trie(spark, monkeypatch, task_rows):
    monkeypatch.setattr(prefix_trie, "TASK_ROWS", task_rows)
    rows = corpus(1) + [(200, t, "user", "same") for t in range(90)] + [(1000 + i, 0, "user", "hot") for i in range(80)]
    random.Random(2).shuffle(rows)
    got = prefix_trie.trie(made(spark, rows)).collect()
    assert order(r[:8] for r in got) == order(brute(rows))
    # the tour: places are a permutation, a subtree is an interval, a parent's holds its children's
    assert sorted(x for r in got for x in (r.enter, r.exit)) == list(range(2 * len(got)))
    spans = {(r.conv_id, r.depth): (r.enter, r.exit) for r in got}
    for r in got:
        if r.depth:
            a, z = spans[r.parent_conv_id, r.depth - 1]
            assert a < r.enter < r.exit < z


def test_awkward_rows(spark):
    rows = [
        (0, None, "user", "null turn first"), (0, 0, None, "no role"), (0, 1, "user", None), (0, 1, "user", None), (0, 1, "assistant", "tie"),
        (1, 0, "user", "x"), (2, 5, None, None), (None, 0, "user", "lost"), (-3, 0, "user", "minus"), (10, 0, "user", "y" * 200_000), (11, 2, "", ""),
        (13, 0, "user", "a"), (13, 0, "user", "a"), (7, 0, "user", "alone"),
    ]
    got = prefix_trie.report(prefix_trie.trie(made(spark, rows))).collect()
    assert order(got) == order(brute(rows))
    assert sum(1 for r in got if r.depth == 0) == 1


def test_empty(spark):
    assert prefix_trie.trie(made(spark, [])).count() == 0
    assert prefix_trie.trie(made(spark, [(None, 1, "user", "x")])).count() == 0


def test_hashes_over_partition_edges():
    rows = [type("R", (), dict(zip(("pid", "conv_id", "j", "o1", "o2"), r))) for r in [(0, 1, 2, 5, 6), (0, 2, 3, 7, 8), (1, 2, 4, 9, 10), (3, 2, 1, 11, 12), (3, 4, 1, 1, 1)]]
    got = prefix_trie.carried(rows)
    r1, r2 = prefix_trie.BASES
    m = 2**64
    assert got[1] == (2, 3, 7, 8)
    assert got[3] == (2, 7, (7 + pow(r1, 3, m) * 9) % m, (8 + pow(r2, 3, m) * 10) % m)
    assert set(got) == {1, 3}
