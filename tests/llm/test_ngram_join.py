import random
import re

import numpy as np
import pytest

from shopflow.llm import ngram_join
from shopflow.llm.components import connected_components

from .helpers import DOCS, awkward, nothing


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = ngram_join.classes(docs).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
    return want


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.5:
            words[i] = f"new{rng.randrange(10**9)}"
        elif kind < 0.75:
            del words[i]
        else:
            words.insert(i, f"ins{rng.randrange(10**9)}")
    return words


def fresh(rng, n):
    return [f"w{rng.randrange(10**7)}" for _ in range(n)]


def test_copies_at_and_around_the_threshold(spark):
    rng, rows = random.Random(1), []
    for size in (3, 5, 8, 12, 30, 66, 90, 200, 480, 520, 640, 700, 1500, 4200):
        for _ in range(3):
            base = fresh(rng, size)
            rows.append(base)
            for share in (0.005, 0.02, 0.03, 0.035, 0.05):
                rows.append(edited(rng, base, max(1, round(size * share))))
            rows.append(base[: round(size * 0.8)])
            rows.append(base[round(size * 0.25) :])
    rng.shuffle(rows)
    want = check(spark, [(i, " ".join(w)) for i, w in enumerate(rows)])
    assert len({c for _, c in want.values()}) < len(rows)


def test_hot_groups_and_shared_passages(spark):
    rng, rows = random.Random(2), []
    hot, passage = fresh(rng, 150), fresh(rng, 60)
    rows += [hot] * 60 + [edited(rng, hot, rng.randint(1, 9)) for _ in range(150)]
    rows += [fresh(rng, n) + passage + fresh(rng, n) for n in (2, 4, 6, 10, 40) for _ in range(25)]
    chain = fresh(rng, 120)
    for _ in range(30):  # a chain whose ends are not similar
        rows.append(chain)
        chain = edited(rng, chain, 3)
    rng.shuffle(rows)
    check(spark, [(i * 7 + 3, " ".join(w)) for i, w in enumerate(rows)])


def test_tiles_find_what_first_pairs_miss(spark, monkeypatch):
    """Groups of several blocks, in which each document is similar to few others."""
    monkeypatch.setattr(ngram_join, "TILE", 8)
    rng, base = random.Random(5), None
    base = fresh(rng, 200)
    far = [edited(rng, base, 14) for _ in range(60)]
    rows = far + [edited(rng, rng.choice(far), 4) for _ in range(40)]
    rng.shuffle(rows)
    check(spark, [(i, " ".join(w)) for i, w in enumerate(rows)])


def test_near_but_unlinked_documents_over_many_tiles(spark, monkeypatch):
    """All documents of a group are near each other, few pairs are linked; tiles give fewer links than components."""
    monkeypatch.setattr(ngram_join, "TILE", 16)
    rng, rows = random.Random(8), []
    for size in (150, 900):
        base = fresh(rng, size)
        far = [edited(rng, base, round(size * 0.035)) for _ in range(50)]
        rows += far + [edited(rng, rng.choice(far), round(size * 0.012)) for _ in range(25)]
    rng.shuffle(rows)
    want = check(spark, [(i, " ".join(w)) for i, w in enumerate(rows)])
    assert 3 < len({c for _, c in want.values()}) < len(rows)


def test_tiles_link_by_a_spanning_forest():
    import pyarrow as pa

    rng = np.random.default_rng(9)
    with np.errstate(over="ignore"):
        base = np.unique(rng.integers(0, 2**62, 300).astype(np.uint64))
        sets = [np.delete(base, rng.permutation(300)[:k]) for k in (0, 3, 5, 60, 100, 100) for _ in range(20)]
        sets += [np.unique(rng.integers(0, 2**62, 290).astype(np.uint64)) for _ in range(5)]
        table = pa.table({"doc": np.arange(len(sets)), "n": [len(s) for s in sets], "component": np.arange(len(sets)) // 2, "side": [3] * len(sets),
                          "sketch": [ngram_join.dense_sketch(s, 0).tobytes() for s in sets], "shingles": [s.view(np.int64).tolist() for s in sets]})
    links = ngram_join.spanning_links(table)
    near = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
    assert all(near(sets[a], sets[b]) for a, b in links)

    def parts(edges):
        root = list(range(len(sets)))
        find = lambda i: i if root[i] == i else find(root[i])
        for a, b in [*edges, *((2 * i, 2 * i + 1) for i in range(len(sets) // 2))]:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(len(sets))]

    assert parts(links) == parts([(a, b) for a in range(len(sets)) for b in range(a) if near(sets[a], sets[b])])
    assert len(links) == len({find for find in parts([])}) - len(set(parts(links)))


def test_tiles_of_very_long_documents_stay_small():
    """Memory of a tile's comparison with the longest sketches is bounded by the block, not by rows squared."""
    import tracemalloc

    import pyarrow as pa

    assert ngram_join.tile_rows(3) * 8 * ngram_join.limit(3) <= 2 * ngram_join.TILE_BYTES and ngram_join.tile_rows(0) == ngram_join.TILE
    rows, size = ngram_join.tile_rows(3) * 2, 2 * ngram_join.limit(3) // 8
    rng = np.random.default_rng(2)
    table = pa.table({"doc": np.arange(rows), "n": np.full(rows, 200_000), "component": np.arange(rows), "side": [3] * rows, "sketch": [rng.bytes(size) for _ in range(rows)]})
    tracemalloc.start()
    assert len(ngram_join.near_pairs(table)[0]) == 0
    assert tracemalloc.get_traced_memory()[1] < 8 * rows * size + 8 * ngram_join.BLOCK_BYTES
    tracemalloc.stop()


def test_shuffle_joins_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    rng = random.Random(6)
    base = fresh(rng, 80)
    check(spark, [(i, " ".join(w)) for i, w in enumerate([base, base, edited(rng, base, 2), fresh(rng, 50)])])


def test_edges(spark):
    docs = awkward(spark)
    rows = docs.collect()
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.classes(docs).collect()}
    want = brute([(r.doc_id, r.text) for r in rows])
    assert all(got[i, n] == c for i, (n, c) in want.items())
    assert [c for (i, _), c in got.items() if i is None] == [None]
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "6", "7", "8", "None"]  # 9 is a near copy of 1
    assert ngram_join.classes(nothing(spark)).count() == 0 and ngram_join.keep_one(nothing(spark)).count() == 0


def test_keep_one_keeps_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 0)] * 3 + [(2, "q w e r t y", "en", "s", 0)], DOCS)
    assert sorted(r.doc_id for r in ngram_join.keep_one(docs).collect()) == [1, 2]


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    with np.errstate(over="ignore"):
        for n, d in ((20, 5), (100, 30), (700, 200)):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            b = np.unique(np.concatenate([a[d:], rng.integers(0, 2**63, d).astype(np.uint64)]))
            difference = len(np.setxor1d(a, b))
            band = ngram_join.bands(n)[0]
            x, y = ngram_join.dense_sketch(a, band), ngram_join.dense_sketch(b, band)
            assert np.bitwise_count(x ^ y).sum() <= difference
            assert len(np.setdiff1d(ngram_join.block_keys(a, band), ngram_join.block_keys(b, band))) <= difference


def test_similar_sets_share_enough_sent_keys():
    rng = np.random.default_rng(4)
    with np.errstate(over="ignore"):
        for size in [*range(2, 40), 60, 64, 100, 300, 511, 512, 600, 682, 683, 684, 700, 2000, 4095, 4096, 5461, 5462]:
            for _ in range(20):
                union = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
                spare = rng.permutation(len(union))[: len(union) // 4]
                k = rng.integers(0, len(spare) + 1)
                a, b = np.delete(union, spare[:k]), np.delete(union, spare[k:])
                if not len(a) or not len(b):
                    continue
                both = set(ngram_join.bands(len(a))) & set(ngram_join.bands(len(b)))
                assert both
                band = min(ngram_join.bands(len(a))[0], ngram_join.bands(len(b))[0])
                assert band in both
                (x, nx), (y, ny) = ngram_join.sent_keys(a, band), ngram_join.sent_keys(b, band)
                assert len(np.intersect1d(x, y)) >= max(nx, ny) >= 1


@pytest.mark.parametrize("links", [[], [(1, 1)], [(2, 1), (3, 2), (4, 3), (9, 8)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)]])
def test_components(spark, links):
    got = {r.vertex: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {v: v for e in links for v in e}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {v: c for v, c in root.items() if any(a != b and v in (a, b) for a, b in links)}
