import numpy as np

from shopflow.llm import ann


def exact(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    keep = np.flatnonzero(ids != ids[q])
    order = keep[np.lexsort((ids[keep], d[keep]))][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


def recall(found, ids, x):
    got = {}
    for r in found:
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        want = exact(ids, x, q, 10)
        hits += sum(i in got[int(ids[q])] for i, _ in want)
        total += len(want)
    return hits / total


def test_recall_and_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = vectors.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    found = ann.search(vectors).collect()
    assert recall(found, ids, x) >= 0.9
    for r in found:
        a, b = x[ids == r.query_id][0], x[ids == r.vec_id][0]
        assert abs(np.sqrt(((a - b) ** 2).sum()) - r.score) < 1e-12
    for q in {r.query_id for r in found}:
        mine = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)


def test_partitions_are_balanced_and_learned():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(8, 16)) * 3
    x = np.concatenate([c + rng.normal(size=(100, 16)) for c in centers])
    graph = ann.neighbours(x, x, 10, np.arange(len(x)))
    label = ann.balanced_parts(x, graph, 8)
    assert np.bincount(label, minlength=8).max() <= np.ceil(800 / 8 * 1.05)
    assert np.mean([np.mean(label[g] == label[v]) for v, g in enumerate(graph)]) > 0.9  # neighbours stay together
    assert (ann.softmax(x, ann.classifier(x, label, 8)).argmax(1) == label).mean() > 0.95


def test_blocks_agree_with_one_search(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROW_BLOCK", 40)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    df = spark.createDataFrame([(i * 25, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = ann.search(df, parts=1).collect()
    ids = np.arange(300) * 25
    for q in range(0, 300, 4):
        assert [(r.vec_id, round(r.score, 12)) for r in sorted((r for r in found if r.query_id == ids[q]), key=lambda r: r.rank)] == [
            (i, round(d, 12)) for i, d in exact(ids, x, q, 10)]


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [0.0, 0.0]), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
            (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (100, [0.0, 2.0]), (9, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "0 AS part", "'x' AS score")
    got = [tuple(r) for r in ann.search(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 6, 0.0), (0, 2, 7, 0.0), (0, 3, 100, 5**0.5), (100, 1, 0, 5**0.5), (100, 2, 6, 5**0.5), (100, 3, 7, 5**0.5)]
    assert ann.search(df.where("vec_id = 1")).count() == 0
    assert ann.search(df.limit(0)).count() == 0
