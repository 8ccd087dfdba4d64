"""Vector best-fit packing of token pieces into sequences.

Each document's ids (with the end id) are cut into pieces of at most
``capacity`` tokens; only longer documents are cut and then the first piece
is the shorter one. Pieces are spread over groups by a hash of their key, so
every group gets the same mix of lengths, and each group packs its own pieces,
longest first: a sequence has residual tokens, residual documents and
residual attention cost (sum of squared lengths), and a piece goes to a
sequence that can take it under every limit: the one with the smallest weighted
norm of the residual vector after it (``norm``), or with the smallest weighted
dot product of its residual vector and the piece's demand (``dot``), which is
the fullest one in the directions that the piece asks for. Sequences with equal
residuals are one state, so a piece looks at states, not at sequences.

Defined results: null text is one piece with the end id. Repeated rows are
packed each. Other columns are ignored. An empty table gives no rows.
The number of groups follows the number of pieces, so a task's memory is
bounded; each group leaves at most about one sequence half filled.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import cut, ship
from shopflow.llm.tokens import END_ID, batch_ids, vocabulary_path

CAPACITY = 1024
#: Pieces that one packing group takes, on average.
GROUP_PIECES = 5_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
SCHEMA = PIECES + ", sequence_id bigint, offset bigint"


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: all full but the first."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document; the ids themselves are not moved."""
    ship(docs.sparkSession)
    vocabulary = vocabulary or vocabulary_path()

    def run(batches):
        for b in batches:
            ids, ends = batch_ids(b.column(1), vocabulary, end_id)
            rows = []
            for key, begin, end in zip(b.column(0).to_pylist(), [0, *ends.tolist()], ends.tolist()):
                at = begin
                for i, n in enumerate(piece_lengths(end - begin, capacity)):
                    rows.append((key, i, at - begin, n, zlib.crc32(ids[at : at + n])))
                    at += n
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def best_fit(lengths: list[int], capacity: int = CAPACITY, max_docs: int = CAPACITY, max_cost: int = CAPACITY**2,
             weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm") -> list[tuple[int, int]]:
    """(sequence, offset) of each length, in the given order; sequences count from 0.

    States are visited by growing token residual and the search stops as soon
    as no larger residual can beat the best score, so the choice is exact.
    """
    w_tokens, w_docs, w_cost = weights[0] / capacity**2, weights[1] / max_docs**2, weights[2] / max_cost**2
    least = min(lengths, default=0)
    states: dict[int, dict[tuple[int, int], list[int]]] = {}
    residuals: list[int] = []  # the token residuals in states, sorted
    out, n_sequences = [], 0
    for n in lengths:
        best, cost = None, n * n
        for i in range(bisect_left(residuals, n), len(residuals)):
            r = residuals[i]
            floor = w_tokens * ((r - n) ** 2 if rule == "norm" else n * r)
            if best is not None and floor >= best[0]:
                break
            for d, c in states[r]:
                if d >= 1 and c >= cost:
                    score = floor + (w_docs * (d - 1) ** 2 + w_cost * (c - cost) ** 2 if rule == "norm" else w_docs * d + w_cost * cost * c)
                    if best is None or score < best[0]:
                        best = (score, r, d, c)
        if best is None:
            r, d, c, sequence = capacity, max_docs, max_cost, n_sequences
            n_sequences += 1
        else:
            _, r, d, c = best
            same = states[r]
            sequence = same[d, c].pop()
            if not same[d, c]:
                del same[d, c]
                if not same:
                    del states[r], residuals[bisect_left(residuals, r)]
        out.append((sequence, capacity - r))
        left = r - n
        if left >= least and left and d > 1:
            if left not in states:
                states[left] = {}
                insort(residuals, left)
            states[left].setdefault((d - 1, c - cost), []).append(sequence)
    return out


def pack(rows: DataFrame, *, capacity: int = CAPACITY, max_docs: int = CAPACITY, max_cost: int | None = None,
         group_pieces: int = GROUP_PIECES, rule: str = "norm") -> DataFrame:
    """Place pieces (a written table, as it is counted first) into sequences."""
    max_cost = max_cost or capacity**2
    groups = max(1, -(-rows.count() // group_pieces))

    def run(got: pa.Table) -> pa.Table:
        number = got.column("group_id")[0].as_py()
        got = got.drop_columns(["group_id"]).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        placed = best_fit(got.column("length").to_pylist(), capacity, max_docs, max_cost, rule=rule)
        got = got.append_column("sequence_id", pa.array([(number << 40) + s for s, _ in placed], pa.int64()))
        return got.append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    number = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).cast("long")
    return rows.withColumn("group_id", number).groupBy("group_id").applyInArrow(run, SCHEMA)


def pack_documents(docs: DataFrame, *, vocabulary: str | None = None, end_id: int = END_ID,
                   capacity: int = CAPACITY, **options) -> DataFrame:
    """Cut, place and return one row per piece."""
    rows = cut(pieces(docs, capacity=capacity, vocabulary=vocabulary, end_id=end_id), "pieces")
    return pack(rows, capacity=capacity, **options)
