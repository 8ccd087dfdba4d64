"""Approximate nearest neighbours by learned partitions.

Fit, on a bounded sample of ``SAMPLE`` vectors: the neighbour graph of the sample is cut
into balanced parts (balanced centres first, then moves that raise the number of
neighbours inside a part while no part grows beyond its bound), a small softmax classifier
learns the parts from the vectors, and on held-out sample vectors the probability mass
that has to be searched for ``TARGET`` recall is calibrated.

Index: the classifier puts every row into its most probable part. Search: a query goes to
its most probable parts until their mass reaches the calibrated one (and until
they hold enough rows), and all rows of those parts are ranked by exact
distance in double precision.

Defined results: vectors that are null, zero, of another length than the most common one, or that hold null or
non-finite components take no part, nor do rows without ``vec_id``. Rows repeated with the same
``vec_id`` and vector count once as candidate; of a query's rows the least vector asks. Ties
go to the smaller ``vec_id``. Other columns are ignored. An empty table gives no rows.

Scale: parts are split into blocks of rows and blocks of queries, and a task compares
one block with another, so a part with a third of all rows is many tasks and
a task's memory is bounded. A task sends the best ``k`` of each of its queries.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import cut, ship

#: Vectors that the graph, its parts and the classifier are fitted on.
SAMPLE = 4096
PARTS = 16
NEIGHBOURS = 10
TARGET = 0.985
#: Rows and queries of one block.
ROW_BLOCK, QUERY_BLOCK = 16_384, 2_048
ROWS = "part int, vec_id bigint, embedding array<double>"
FOUND = "query_id bigint, vec_id bigint, score double"


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.col("vec_id").isNotNull() & e.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(e, lambda x: x != 0))


def neighbours(x: np.ndarray, y: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Positions in ``y`` of the k nearest of each row of ``x``; ``own`` are positions to leave out."""
    d = (y * y).sum(1)[None, :] - 2 * x @ y.T
    if own is not None:
        d[np.arange(len(x)), own] = np.inf
    return np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k]


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 7, passes: int = 8, slack: float = 0.05) -> np.ndarray:
    """A part for each vertex of the neighbour graph; no part exceeds its share by more than ``slack``."""
    rng, n = np.random.default_rng(seed), len(x)
    most = math.ceil(n / parts * (1 + slack))
    centers = x[rng.choice(n, parts, replace=False)]
    label = np.zeros(n, np.int64)
    for _ in range(12):
        d = (centers * centers).sum(1)[None, :] - 2 * x @ centers.T
        size = np.zeros(parts, np.int64)
        order = np.argsort(d.min(1) - np.partition(d, min(1, parts - 1), axis=1)[:, min(1, parts - 1)])
        ranked = np.argsort(d, axis=1)
        for v in order:  # those with the clearest choice first
            p = next(p for p in ranked[v] if size[p] < most)
            label[v] = p
            size[p] += 1
        centers = np.stack([x[label == p].mean(0) if (label == p).any() else centers[p] for p in range(parts)])
    both: list[list[int]] = [list(map(int, g)) for g in graph]
    for v, g in enumerate(graph):
        for u in g:
            both[int(u)].append(v)
    size = np.bincount(label, minlength=parts)
    for _ in range(passes):
        moved = 0
        for v in rng.permutation(n):
            near = np.bincount(label[both[v]], minlength=parts)
            p = int(np.argmax(np.where(size < most, near, -1)))
            if near[p] > near[label[v]]:
                size[label[v]] -= 1
                size[p] += 1
                label[v] = p
                moved += 1
        if not moved:
            break
    return label


def softmax(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    z = x @ model[0] + model[1]
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def classifier(x: np.ndarray, label: np.ndarray, parts: int, steps: int = 300, rate: float = 1.0, decay: float = 1e-4):
    """Weights and offsets of a softmax classifier, by gradient steps with momentum over all sample rows."""
    w, b = np.zeros((x.shape[1], parts)), np.zeros(parts)
    vw, vb, hot = np.zeros_like(w), np.zeros_like(b), np.eye(parts)[label]
    scale = 1 / max(1e-12, float((x * x).sum(1).mean()))
    for _ in range(steps):
        g = (softmax(x, (w, b)) - hot) / len(x)
        vw = 0.9 * vw - rate * 4 * scale * (x.T @ g + decay * w)
        vb = 0.9 * vb - rate * g.sum(0)
        w, b = w + vw, b + vb
    return w, b


def searched(p: np.ndarray, mass: float, sizes: np.ndarray, least: int) -> np.ndarray:
    """Which parts each query searches: the most probable ones up to ``mass``, and until they hold ``least`` rows."""
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, 1), 1) - np.take_along_axis(p, order, 1)
    rows = np.cumsum(sizes[order], 1) - sizes[order]
    out = np.zeros(p.shape, bool)
    np.put_along_axis(out, order, (before < mass) | (rows < least), 1)
    return out


def fit(x: np.ndarray, parts: int = PARTS, k: int = NEIGHBOURS, target: float = TARGET, seed: int = 7):
    """(classifier, mass) from sample vectors: parts and classifier on three quarters, the mass on the rest."""
    n = len(x)
    parts = max(1, min(parts, n // 32))
    if parts == 1:
        return (np.zeros((x.shape[1], 1)), np.zeros(1)), 1.0
    held = np.arange(n) % 4 == 3
    train, test = x[~held], x[held]
    graph = neighbours(train, train, k, np.arange(len(train)))
    model = classifier(train, balanced_parts(train, graph, parts, seed), parts)
    near = neighbours(test, x, k, np.flatnonzero(held))
    p, home = softmax(test, model), softmax(x, model).argmax(1)
    # the mass that must be searched before each true neighbour's part is reached
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, 1), 1) - np.take_along_axis(p, order, 1)
    reached = np.empty_like(before)
    np.put_along_axis(reached, order, before, 1)
    needed = np.sort(np.take_along_axis(reached, home[near], 1).ravel())
    return model, float(np.nextafter(needed[min(len(needed) - 1, math.ceil(target * len(needed)))], 2))


def nearest(queries: np.ndarray, ids: np.ndarray, x: np.ndarray, names: np.ndarray, k: int):
    """(query, candidate, distance) of the k nearest rows of ``x``, exactly; ties to the smaller name."""
    xx, out = (x * x).sum(1), []
    scale = float(xx.max()) + float((queries * queries).sum(1).max()) if len(x) else 0.0
    for at in range(0, len(queries), 256):
        q = queries[at : at + 256]
        rough = xx[None, :] - 2 * q @ x.T + (q * q).sum(1)[:, None]
        rough[ids[at : at + 256, None] == names[None, :]] = np.inf
        kth = np.partition(rough, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
        for i in range(len(q)):
            c = np.flatnonzero((rough[i] <= kth[i] + 1e-9 * scale) & np.isfinite(rough[i]))
            d = np.sqrt(((q[i] - x[c]) ** 2).sum(1))
            for j in np.lexsort((names[c], d))[:k]:
                out.append((int(ids[at + i]), int(names[c[j]]), float(d[j])))
    return out


def matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def search(vectors: DataFrame, *, k: int = 10, every: int = 100, sample: int = SAMPLE, parts: int = PARTS, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row whose ``vec_id`` is divisible by ``every``."""
    spark = ship(vectors.sparkSession)
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    rows = valid(vectors)
    dims = rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return spark.createDataFrame([], empty)
    dim = dims["dim"]
    rows = rows.where(F.size("embedding") == dim)
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(sample).select("embedding").collect()
    model, mass = fit(np.array([r[0] for r in picked], np.float64), parts, target=target)

    def index(batches):
        for b in batches:
            if b.num_rows:
                home = softmax(matrix(b.column(1), dim), model).argmax(1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(home), b.column(0), b.column(1)], ["part", "vec_id", "embedding"])

    indexed = cut(rows.mapInArrow(index, ROWS), "ann_index")
    is_query = F.col("vec_id") % every == 0
    queries = indexed.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    n_parts = model[1].size
    sizes = np.zeros(n_parts, np.int64)
    for r in indexed.groupBy("part").count().collect():  # one row per part
        sizes[r["part"]] = r["count"]

    def route(batches):
        for b in batches:
            if b.num_rows:
                q, p = np.nonzero(searched(softmax(matrix(b.column(1), dim), model), mass, sizes, k + 1))
                yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), b.column(0).take(pa.array(q)), b.column(1).take(pa.array(q))], ["part", "vec_id", "embedding"])

    asked = cut(queries.mapInArrow(route, ROWS), "ann_queries")
    counts = np.zeros(n_parts, np.int64)
    for r in asked.groupBy("part").count().collect():
        counts[r["part"]] = r["count"]
    row_blocks = F.element_at(F.array(*[F.lit(max(1, -(-int(n) // ROW_BLOCK))) for n in sizes]), F.col("part") + 1)
    query_blocks = F.element_at(F.array(*[F.lit(max(1, -(-int(n) // QUERY_BLOCK))) for n in counts]), F.col("part") + 1)
    number = lambda n: F.pmod(F.xxhash64("vec_id"), n).cast("int")
    tile = ("part", "i", "j")
    left = asked.select("part", F.explode(F.sequence(F.lit(0), row_blocks - 1)).alias("i"), number(query_blocks).alias("j"), "vec_id", "embedding")
    right = indexed.dropDuplicates(["vec_id", "embedding"]).select(
        "part", number(row_blocks).alias("i"), F.explode(F.sequence(F.lit(0), query_blocks - 1)).alias("j"), "vec_id", "embedding")

    def compare(q: pa.Table, x: pa.Table) -> pa.Table:
        found = []
        if q.num_rows and x.num_rows:
            found = nearest(matrix(q.column("embedding"), dim), q.column("vec_id").to_numpy(), matrix(x.column("embedding"), dim), x.column("vec_id").to_numpy(), k)
        a, b, c = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    found = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInArrow(compare, FOUND)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
