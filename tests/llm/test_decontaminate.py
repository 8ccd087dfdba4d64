import hashlib
import random
import re

import numpy as np
import pytest

from shopflow.llm import decontaminate as dc

from .helpers import DOCS, LONG, awkward, nothing

BENCH = "item_id long, text string, n_words int, items string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench):
    windows = {}
    for item, text in bench:
        w = words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w, hit, items = words(text), set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    items |= windows[tuple(w[i : i + k])]
        names = sorted(str(i) for i in items if i is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a", "it", "Don't", "é", "日本", "x9"] + [f"v{i}" for i in range(12)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    bench = [(i, text(rng.choice([1, 2, 3, 9, 10, 11, 30]))) for i in range(25)] + [(3, text(40)), (None, text(12)), (99, None), (100, "- !"), (10, "")]
    docs = []
    for i in range(120):
        parts = [text(rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            w = words(rng.choice(bench)[1])
            at = rng.randrange(0, len(w) + 1)
            parts += [" ".join(w[at : at + rng.randrange(5, 25)]).upper(), text(rng.randrange(0, 9))]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    passage = text(60)
    return docs + [(200 + i, passage) for i in range(40)] + [(5, docs[5][1]), (None, passage), (300, None), (301, "")], [*bench, (500, passage)]


def frames(spark, docs, bench):
    return (spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS), spark.createDataFrame([(i, t, 0, "x") for i, t in bench], BENCH))


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, str(r)))


@pytest.mark.parametrize("shard_words", [1, 300, 1 << 20])
def test_against_all_windows(spark, shard_words):
    docs, bench = corpus()
    d, b = frames(spark, docs, bench)
    got = dc.report(dc.mark(d, b, shard_words=shard_words)).collect()
    assert order(got) == order(brute(docs, bench))
    assert 0 < sum(r.contaminated for r in got) < len(got)


def test_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 400)
    docs, bench = corpus(2)
    d, b = frames(spark, docs, bench)
    assert order(dc.report(dc.mark(d, b)).collect()) == order(brute(docs, bench))


def test_clean_keeps_columns_and_only_clean_rows(spark):
    docs, bench = corpus()
    d, b = frames(spark, docs, bench)
    d = d.withColumns({"row": d.doc_id, "spans": d.text})
    kept = dc.clean(d, b)
    assert kept.columns == d.columns
    want = [i for (i, *_, bad) in brute(docs, bench) if not bad]
    assert order((r.doc_id,) for r in kept.collect()) == order((i,) for i in want)


def test_longest_matches(spark):
    docs, bench = corpus(4)
    bench = [(i, t) for i, t in enumerate(t for _, t in bench)]
    d, b = frames(spark, docs, bench)
    sets = [(i, words(t)) for i, t in docs]
    for shard_words in (50, 1 << 20):
        got = {(r.item_id, r.start): (r.length, r.places, r.doc_id, r.offset) for r in dc.longest_matches(d, b, least=12, shard_words=shard_words).collect()}
        want = {}
        for item, text in bench:
            w = words(text)
            for s in range(len(w)):
                best = {}
                for doc, x in sets:
                    for o in range(len(x)):
                        n = 0
                        while s + n < len(w) and o + n < len(x) and w[s + n] == x[o + n]:
                            n += 1
                        if n >= 12:
                            best.setdefault(n, []).append((doc is None, doc or 0, doc, o))
                if best:
                    n = max(best)
                    want[str(item), s] = (n, len(best[n]), *min(best[n])[2:])
        assert got == want and got


def test_awkward_rows(spark):
    docs = awkward(spark)
    bench = spark.createDataFrame([(1, LONG[-300:], 0, ""), (2, "naïve 日本語 Token ABCDEF0123456789abcdef01", 0, ""), (None, None, None, None)], BENCH)
    got = dc.report(dc.mark(docs, bench)).collect()
    assert order(got) == order(brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()]))
    assert {r.doc_id for r in got if r.contaminated} == {6, 8}
    none = spark.createDataFrame([], BENCH)
    assert dc.mark(nothing(spark), bench).count() == 0 and dc.clean(docs, none).count() == docs.count()
    assert dc.longest_matches(docs, none).count() == 0


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(5)
    for n, values in ((1, 1), (60, 1), (200, 2), (400, 50)):
        for wide in (False, True):
            words_ = rng.integers(0, values, n).astype(np.uint64) * np.uint64(1 if not wide else 2**40) | dc.TOP
            tokens = np.concatenate([words_[: n // 2], [np.uint64(0)], words_[n // 2 :], [np.uint64(1)]])
            want = sorted(range(len(tokens)), key=lambda i: tokens[i:].tolist())
            assert dc.suffix_array(tokens).tolist() == want
