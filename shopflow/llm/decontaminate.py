"""Benchmark decontamination with suffix arrays of the training texts.

Each task deals its documents, in the order it reads them, to shards of about
``SHARD_WORDS`` words and sorts the suffixes of a shard: words are 64-bit hashes,
each document ends with a separator of its own, and prefix doubling orders the
suffixes, where only those that are not told apart yet are sorted again. Every
suffix of every benchmark item is then searched in the shard: its range of the
suffix array is narrowed by binary search, one word deeper each time, until
it is empty. That gives the longest verbatim match of each suffix, and the range at
a window's length holds all places of that window.

The documents are read once and not shuffled. A task holds one shard and one block
of the benchmark. The benchmark is counted first and broadcast in blocks of about
``BLOCK_BYTES`` bytes of text; when there are several, each block is a pass of its own
whose input carries what earlier passes found.

Defined results: null text has no words and is not contaminated. An item without
words is never found; a null ``item_id`` marks words but is not counted or listed.
Equal ``item_id``s count once. Repeated documents are marked each, a null
``doc_id`` too. Other columns are ignored by ``mark`` and kept by ``clean``. Without
documents there are no rows; without items nothing is contaminated. Words are
compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import cut, ship

WINDOW = 10
#: Words of one shard, but for a longer single document. It bounds a task's memory, not the work.
SHARD_WORDS = 1 << 20
#: Bytes of benchmark texts that one broadcast holds, on average over blocks.
BLOCK_BYTES = 16 << 20
FOUND = "n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"
MATCHES = "item_id string, start int, length int, places bigint, doc_id bigint, offset int"
#: Bytes of words: digits, letters (A-Z in lower case) and all bytes of code points above ASCII; others part words.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
TOP = np.uint64(1 << 63)


def hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words, with the top bit set: separators are smaller."""
    from xxhash import xxh3_64_intdigest

    words = text.encode().translate(TABLE).split()
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)) | TOP


def sorted_by(high: np.ndarray, low: np.ndarray, index: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``index`` ordered by (high, low), and where a new pair begins; all values are below 2**bits."""
    if 3 * bits <= 64:  # one sort of plain numbers
        b = np.uint64(bits)
        key = np.sort((((high.astype(np.uint64) << b) | low.astype(np.uint64)) << b) | index.astype(np.uint64))
        order, key = (key & np.uint64((1 << bits) - 1)).astype(np.int64), key >> b
    else:
        key = (high.astype(np.uint64) << np.uint64(bits)) | low.astype(np.uint64)
        by = np.argsort(key, kind="stable")
        order, key = index[by], key[by]
    return order, np.r_[True, key[1:] != key[:-1]]


def first_order(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Positions ordered by token: by its upper bits with the position below, unless two tokens share the upper bits."""
    low = np.uint64((1 << bits) - 1)
    order = (np.sort((tokens & ~low) | np.arange(len(tokens), dtype=np.uint64)) & low).astype(np.int64)
    got = tokens[order]
    return order if (got[1:] >= got[:-1]).all() else np.argsort(tokens, kind="stable")


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Positions of ``tokens`` in the order of their suffixes. The last token and each document's end occur once."""
    n = len(tokens)
    bits = max(1, n.bit_length())
    # separators are small numbers: moved up, so that they keep their order among the upper bits
    order = first_order(np.where(tokens < TOP, tokens << np.uint64(bits), tokens), bits)
    got = tokens[order]
    new = np.r_[True, got[1:] != got[:-1]]
    rank = np.empty(n, np.int64)
    slots, h = np.arange(n), 1
    while True:
        # slots: places of the array that are sorted anew; new: where a group begins in them
        begins = np.flatnonzero(new)
        sizes = np.diff(np.r_[begins, len(slots)])
        rank[order[slots]] = np.repeat(slots[begins], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        if not len(slots):
            return order
        index = order[slots]
        order[slots], new = sorted_by(rank[index], rank[index + h], index, bits)
        h *= 2


def narrowed(tokens, array, low, high, depth: int, wanted, right: bool) -> np.ndarray:
    """Binary search in each range for the first suffix whose word at ``depth`` is not below (``right``: is above) the wanted one."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        mid = np.where(open_, (low + high) >> 1, 0)
        at = tokens[np.minimum(array[mid] + depth, len(tokens) - 1)]
        below = open_ & ((at <= wanted) if right else (at < wanted))
        low = np.where(below, mid + 1, low)
        high = np.where(open_ & ~below, mid, high)
    return low


def search(tokens, array, tests, stops, windows):
    """For each suffix ``tests[i:stops[i]]``: the length of its longest match, that match's range, and the range of its first ``windows[i]`` words."""
    heads = tokens[array]
    low, high = (np.searchsorted(heads, tests, side) for side in ("left", "right"))
    length = (high > low).astype(np.int64)
    at_window = np.zeros((2, len(tests)), np.int64)
    live, depth = np.flatnonzero(length), 1
    while len(live):
        full = live[windows[live] == depth]
        at_window[:, full] = low[full], high[full]
        live = live[live + depth < stops[live]]
        wanted, a, z = tests[live + depth], low[live], high[live]
        apart = np.flatnonzero((tokens[array[a] + depth] != wanted) | (tokens[array[z - 1] + depth] != wanted))
        if len(apart):
            a[apart], z[apart] = (narrowed(tokens, array, low[live[apart]], high[live[apart]], depth, wanted[apart], right) for right in (False, True))
        kept = z > a
        live = live[kept]
        low[live], high[live] = a[kept], z[kept]
        depth += 1
        length[live] = depth
    return length, low, high, at_window


class Tests:
    """The suffixes of one block of items."""

    def __init__(self, rows: list[tuple[object, str | None]], window: int = WINDOW):
        parts = [(i, hashes(t or "")) for i, t in rows]
        parts = [(i, h) for i, h in parts if len(h)]
        sizes = np.array([len(h) for _, h in parts], np.int64)
        ends = np.cumsum(sizes)
        self.ids = [None if i is None else str(i) for i, _ in parts]
        self.tokens = np.concatenate([h for _, h in parts]) if parts else np.empty(0, np.uint64)
        self.item = np.repeat(np.arange(len(parts)), sizes)
        self.start = np.arange(len(self.tokens)) - np.repeat(ends - sizes, sizes)
        self.stops = np.repeat(ends, sizes)
        whole = np.minimum(np.repeat(sizes, sizes), window)
        self.windows = np.where(self.stops - np.arange(len(self.tokens)) >= whole, whole, 0)


class Shard:
    """The suffix array of some documents."""

    def __init__(self, parts: list[np.ndarray]):
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.tokens = np.concatenate([x for i, p in enumerate(parts) for x in (p, np.array([i], np.uint64))])
        self.array = suffix_array(self.tokens)

    def places(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Document numbers and word offsets of a range."""
        at = self.array[low:high]
        doc = np.searchsorted(self.starts, at, "right") - 1
        return doc, at - self.starts[doc]

    def windows(self, tests: Tests):
        """(start, end) of the words hit and the ids of the items found, for each document."""
        spans: list[list[tuple[int, int]]] = [[] for _ in self.sizes]
        items: list[set[str]] = [set() for _ in self.sizes]
        _, _, _, (low, high) = search(self.tokens, self.array, tests.tokens, tests.stops, tests.windows)
        found = np.flatnonzero(high > low)
        if len(found):
            change = np.zeros(len(self.tokens) + 1, np.int32)
            for a, z, w in np.unique(np.stack([low[found], high[found], tests.windows[found]]), axis=1).T:
                change[self.array[a:z]] += 1  # places of a range differ
                change[self.array[a:z] + w] -= 1
            hit = np.r_[False, np.cumsum(change) > 0]  # one False in front; a separator is never hit
            edges = np.flatnonzero(hit[1:] != hit[:-1]).reshape(-1, 2)
            docs = np.searchsorted(self.starts, edges[:, 0], "right") - 1
            for d, (a, z) in zip(docs.tolist(), (edges - self.starts[docs][:, None]).tolist()):
                spans[d].append((a, z))
            for item in np.unique(tests.item[found]):
                if tests.ids[item] is not None:
                    ranges = {(int(low[i]), int(high[i])) for i in found[tests.item[found] == item]}
                    for d in set().union(*(np.unique(self.places(a, z)[0]).tolist() for a, z in ranges)):
                        items[d].add(tests.ids[item])
        return spans, items

    def longest(self, tests: Tests, least: int, ids: list[int | None]):
        """(suffix, length, places, document id, offset) of the longest matches of ``least`` words or more; the place is the one with the least id."""
        last = np.iinfo(np.int64).max  # a null id
        by_id = np.array([last if i is None else i for i in ids], np.int64)
        length, low, high, _ = search(self.tokens, self.array, tests.tokens, tests.stops, tests.windows)
        for i in np.flatnonzero(length >= least).tolist():
            doc, offset = self.places(int(low[i]), int(high[i]))
            k = np.lexsort((offset, by_id[doc]))[0]
            yield i, int(length[i]), len(doc), ids[doc[k]], int(offset[k])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps; touching ones are joined."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def shards(batches, column: str, words: int):
    """(rows, shard) of successive rows with about ``words`` words; rows are Arrow batches."""
    held, parts, total = [], [], 0
    for batch in batches:
        start = 0
        for i, text in enumerate(batch.column(column).to_pylist()):
            parts.append(hashes(text or ""))
            total += len(parts[-1])
            if total >= words:
                yield [*held, batch.slice(start, i + 1 - start)], Shard(parts)
                held, parts, total, start = [], [], 0, i + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if parts:
        yield held, Shard(parts)


def blocks(benchmark: DataFrame, window: int):
    """The benchmark's blocks, broadcast one by one."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // BLOCK_BYTES
    for i in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()  # bounded by BLOCK_BYTES on average
        yield benchmark.sparkSession.sparkContext.broadcast(Tests([tuple(r) for r in rows], window)), i + 1 < n


def found(docs: DataFrame, benchmark: DataFrame, window: int, shard_words: int) -> DataFrame:
    """``docs`` (row, text) with n_words, spans and items."""
    state = docs.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.lit(None).cast("array<struct<start:int,end:int>>"),
                              "items": F.lit(None).cast("array<string>")})
    schema = state.schema
    struct = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for tests, more in blocks(benchmark, window):
        def run(batches, tests=tests):
            for held, shard in shards(batches, "text", shard_words):
                spans, items = shard.windows(tests.value)
                at = 0
                for b in held:
                    old = zip(b.column("spans").to_pylist(), b.column("items").to_pylist())
                    now = [(merged([*((s["start"], s["end"]) for s in o or ()), *x]), sorted({*(p or ()), *y}))
                           for (o, p), x, y in zip(old, spans[at:], items[at:])]
                    yield pa.RecordBatch.from_arrays([
                        b.column("row"), b.column("text"), pa.array(shard.sizes[at : at + len(now)]),
                        pa.array([[{"start": a, "end": z} for a, z in s] for s, _ in now], struct),
                        pa.array([x for _, x in now], pa.list_(pa.string()))], ["row", "text", "n_words", "spans", "items"])
                    at += len(now)

        state = state.mapInArrow(run, schema)
        if more:
            state = cut(state, "contamination")
    return state


def mark(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, spans of the words hit, ids of the items found) of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    rows = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id")).alias("row"), "text")
    return found(rows, benchmark, window, shard_words).select("row.doc_id", "n_words", "spans", "items")


def clean(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs``, all columns, without the rows that hold a window of the benchmark."""
    ship(docs.sparkSession)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    return found(rows, benchmark, window, shard_words).where(F.size("spans") == 0).select("row.*")


def longest_matches(docs: DataFrame, benchmark: DataFrame, *, least: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(item_id, start, length, places, doc_id, offset) of each benchmark suffix with a verbatim match of ``least`` words or more.

    ``length`` is the longest match over all documents, ``places`` how often it occurs, and (doc_id, offset) its first place.
    A suffix is named by its item and its first word's number; of items with equal ids the longest match stays.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = None
    for tests, _ in blocks(benchmark, least):
        def run(batches, tests=tests):
            for held, shard in shards(batches, "text", shard_words):
                ids = [x for b in held for x in b.column("doc_id").to_pylist()]
                got = [(tests.value.ids[tests.value.item[i]], int(tests.value.start[i]), n, places, doc, offset)
                       for i, n, places, doc, offset in shard.longest(tests.value, least, ids)]
                columns = list(zip(*got)) if got else [()] * 6
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["item_id", "start", "length", "places", "doc_id", "offset"])

        part = rows.mapInArrow(run, MATCHES)
        every = part if every is None else every.union(part)
    by_length = every.groupBy("item_id", "start", "length").agg(F.sum("places").alias("places"), F.min(F.struct(F.isnull("doc_id"), "doc_id", "offset")).alias("place"))
    best = by_length.groupBy("item_id", "start").agg(F.max(F.struct("length", "places", "place")).alias("best"))
    return best.select("item_id", "start", "best.length", "best.places", "best.place.doc_id", "best.place.offset")


def report(marked: DataFrame) -> DataFrame:
    """The rows of ``mark`` as counts and a checksum of the items."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return marked.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bp AS (SELECT item_id, ws, least(len(ws), 10) AS k, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM bw WHERE len(ws) > 0),
b AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM bp),
dp AS (SELECT r, ws, l.k, unnest(range(1, len(ws) - l.k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM b) l WHERE len(ws) >= l.k),
d AS (SELECT r, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM dp),
m AS (SELECT d.r, d.i, d.k, b.item_id FROM d JOIN b ON b.k = d.k AND b.g = d.g),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + k)) AS p FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT dw.doc_id, len(dw.ws) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""
