import hashlib
import random

import numpy as np

from shopflow.llm import mixing

from .helpers import DOCS, awkward, nothing


def documents(spark, n=600):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        text = " ".join("word" for _ in range(rng.randint(1, 60))) + rng.choice(["", "", " a@b.c", " x | y", " password = abc", " Licensed under X"])
        rows.append((i, text, rng.choice(["en", "en", "de", None]), "hot" if i % 3 == 0 else f"s{rng.randrange(4)}", 0))
    return spark.createDataFrame(rows, DOCS)


def brute(rows, share=mixing.SHARE):
    """Raking and the scale on dictionaries; the scale is found by bisection."""
    cells = {}
    for r in rows:
        cells[r.source, r.lang, r.topic] = cells.get((r.source, r.lang, r.topic), 0) + r.n_tokens
    w = {k: float(v) for k, v in cells.items()}
    for _ in range(mixing.ROUNDS):
        for i, m in enumerate(mixing.MARGINS):
            for value in {k[i] for k in w}:
                target = sum(v for k, v in cells.items() if k[i] == value) ** mixing.TEMPER[m]
                now = sum(v for k, v in w.items() if k[i] == value)
                for k in w:
                    if k[i] == value and now:
                        w[k] *= target / now
    total, low, high = sum(cells.values()), 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(cells[k], mid * w[k]) for k in w) < share * total else (low, mid)
    return {k: (w[k] / cells[k] * total / sum(w.values()), min(1.0, low * w[k] / cells[k])) for k in w if cells[k]}


def test_against_brute_force(spark):
    rows = mixing.weigh(documents(spark)).collect()
    want = brute(rows)
    for r in rows:
        weight, p = want[r.source, r.lang, r.topic]
        assert abs(r.weight - weight) < 1e-5 and abs(r.probability - p) < 1e-5
        u = int(hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest()[:8], 16) / 2**32
        assert r.selected == (u < r.probability)
    total = sum(r.n_tokens for r in rows)
    assert abs(sum(r.n_tokens * r.probability for r in rows) - mixing.SHARE * total) < 0.01 * total


def test_marginals_meet_named_targets(spark):
    docs = documents(spark).fillna("xx", ["lang"])
    targets = {"source": {"hot": 0.2, "s0": 0.2, "s1": 0.2, "s2": 0.2, "s3": 0.2}, "lang": {"en": 0.5, "de": 0.25, "xx": 0.25},
               "topic": {"prose": 0.4, "contact": 0.2, "table": 0.2, "credential": 0.1, "license": 0.1}}
    rows = mixing.weigh(docs, targets=targets).collect()
    total = sum(r.weight * r.n_tokens for r in rows)
    for m in mixing.MARGINS:
        for value, share in targets[m].items():
            assert abs(sum(r.weight * r.n_tokens for r in rows if r[m] == value) / total - share) < 2e-3


def test_sample_is_what_weigh_selects(spark):
    docs = documents(spark)
    kept = mixing.sample(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in mixing.weigh(docs).where("selected").collect())


def test_shuffle_join_beyond_the_bound(spark, monkeypatch):
    docs = documents(spark)
    want = sorted(map(tuple, mixing.weigh(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, mixing.weigh(docs).collect())) == want


def test_edges(spark):
    docs = awkward(spark)
    rows = mixing.weigh(docs).collect()
    assert len(rows) == 11 and all(0 <= r.probability <= 1 for r in rows)
    assert all(r.selected for r in rows if r.probability == 1)
    assert mixing.sample(docs).columns == docs.columns
    assert mixing.weigh(nothing(spark)).count() == 0 and mixing.sample(nothing(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = mixing.weigh(awkward(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert np.isfinite([r.weight for r in mixing.weigh(documents(spark, 30)).collect()]).all()
