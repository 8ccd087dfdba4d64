"""N-gram Jaccard join by parity sketches.

A document's set holds the 64-bit hashes of its distinct 5-word shingles.

Sketch. Every shingle flips one bit of a sparse bit sketch that is divided
into blocks, so bits of shared shingles cancel and the Hamming distance of two
sketches is at most the symmetric difference of the sets; a block's key is the
XOR of the hashes of its set bits. Sets of similar size share a scheme (a size
band): the number of blocks follows the band's upper size, and sets below 512
shingles have one block for each. A set that is up to 4/3 of a lower band's limit
takes part in that band too, so each pair that can link meets in a band.

Pigeonhole. For a set of size a, a partner's symmetric difference is at most
D = a/3 (a Jaccard of 3/4 or more allows (a + b) / 7 and b <= 4a/3). At most D of
its filled blocks differ, so the first D + 1 + s block keys in hash order hold
at least ``need`` > s' shared ones. Keys are joined once. A document with fewer
than ``need`` shared keys can have no partner and goes; of the others, only the
rarest ``shared - need + 1`` keys have to be looked at (prefix principle), so
keys of passages that many documents share are the last ones used.

Verify. Candidates must pass the size ratio, the Hamming distance of dense
parity sketches (2 bits for each shingle of the band's upper size) and at last the
exact intersection. Within one key's documents, each is compared with the
first and with its neighbour by size, then with neighbours of other components.
Where components still meet in a key, tasks compare the dense sketches of their
documents in tiles of bounded size, check those under the Hamming bound exactly inside the
tile, and give a spanning forest of links: pairs never become rows. So no link between
components is lost, linked documents are not compared again, and a large group of
documents that are near, linked or not, does not become all its pairs.

Exact copies of a set are joined once, by their least ``doc_id``. Lists of ids are broadcast against the texts only
when their counted rows are below ``BROADCAST_IDS``; beyond, texts are joined by shuffle.

Defined results: null or wordless text has an empty set and is linked with
nothing; fewer than five words are one shingle. Rows with the same ``doc_id``
are one vertex. A null ``doc_id`` gets a null component. Other columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import cut, map_text, ship
from shopflow.llm.components import connected_components

NGRAM = 5
#: Sets below the first limit have a block for each shingle; limits grow by the factor.
FIRST_LIMIT, FACTOR = 512, 8
#: A set of size a sends a / SLACK block keys beyond the pigeonhole's D + 1. More keys raise ``need`` above what
#: shared passages alone bring together.
SLACK = 3
#: Ids (8 bytes each) up to which a list is broadcast.
BROADCAST_IDS = 2_000_000
#: Documents of one key that a tile holds on each side, bytes of their sets, and bytes of sketches compared at once.
TILE, TILE_BYTES, BLOCK_BYTES = 1024, 32 << 20, 4 << 20
U64 = np.uint64
#: Odd multipliers of the rolling shingle hash.
ODD = tuple(U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
ROWS = "doc_id bigint, n int, band int, need int, keys array<bigint>"
SETS = "doc_id bigint, shingles array<bigint>, bands array<int>, sketches array<array<bigint>>, packed array<binary>"


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    x = x + U64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingles(text: str, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    from xxhash import xxh3_64_intdigest

    words = text.encode().lower().split()  # bytes: A-Z only, and exactly the six white-space characters
    if not words:
        return np.empty(0, U64)
    if len(words) < n:
        return np.array([xxh3_64_intdigest(b" ".join(words), 1)], U64)
    w = np.fromiter(map(xxh3_64_intdigest, words), U64, len(words))
    k = len(w) - n + 1
    total = w[:k] * ODD[0]
    for i in range(1, n):
        total += w[i : i + k] * ODD[i]
    return np.unique(mix(total))


def limit(band: int) -> int:
    """First size above the band."""
    return FIRST_LIMIT * FACTOR**band


def bands(size: int) -> list[int]:
    """The band of a size, and the one below when partners can be there."""
    b = 0
    while size >= limit(b):
        b += 1
    return [b, b - 1] if b and 3 * size < 4 * limit(b - 1) else [b]


def block_keys(s: np.ndarray, band: int) -> np.ndarray:
    """Sorted keys of the filled blocks of a set's sparse parity sketch."""
    if band == 0:
        return np.sort(mix(s, 11))
    blocks = mix(s, 13 + band) & U64(limit(band) - 1)
    order = np.argsort(blocks, kind="stable")
    blocks, bits = blocks[order], mix(s, 101 + band)[order]
    at = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
    return np.sort(mix(np.bitwise_xor.reduceat(bits, at) ^ mix(blocks[at], 211 + band), 307))


def sent_keys(s: np.ndarray, band: int) -> tuple[np.ndarray, int]:
    """The keys that take part in the join, and how many of them any partner shares."""
    a, keys = len(s), block_keys(s, band)
    differing = a // 4 if band == 0 else a // 3
    need = max(1, min(-(-3 * a // 4) // SLACK + 1, len(keys) - differing))
    return keys[: differing + 1 + a // SLACK], need


def dense_sketch(s: np.ndarray, band: int) -> np.ndarray:
    """Parity bits of a set in 2 * limit(band) bits, as 64-bit words."""
    size = 2 * limit(band)
    at = (mix(s, 401 + band) & U64(size - 1)).astype(np.int64)
    bits = (np.bincount(at, minlength=size) & 1).astype(np.uint8)
    return np.packbits(bits).view("<u8")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, U64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(U64).view(np.int64)))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    return tuple(int(mix(s, seed).sum(dtype=U64).view(np.int64)) for seed in (3, 5)) if len(s) else (0, 0)


def _sketch_rows(ids, texts):
    out = {k: [] for k in ("doc_id", "n", "band", "need", "keys")}
    with np.errstate(over="ignore"):
        for doc_id, text in zip(ids.to_pylist(), texts):
            s = shingles(text)
            for band in bands(len(s)) if len(s) else ():
                keys, need = sent_keys(s, band)
                for name, v in zip(out, (doc_id, len(s), band, need, keys)):
                    out[name].append(v)
    return out | {"keys": _lists(out["keys"])}


def _set_rows(ids, texts):
    sets, held, dense = [], [], []
    with np.errstate(over="ignore"):
        for text in texts:
            s = shingles(text)
            b = bands(len(s))
            sets.append(s)
            held.append(b)
            dense.append([dense_sketch(s, x) for x in b])
    return {"doc_id": ids, "shingles": _lists(sets), "bands": held, "sketches": [[x.view(np.int64).tolist() for x in d] for d in dense],
            "packed": [[x.tobytes() for x in d] for d in dense]}


def hamming(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)


def sketch_of(bands_: Column, sketches: Column, band: Column) -> Column:
    return F.get(sketches, F.array_position(bands_, band).cast("int") - 1)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of documents whose Jaccard similarity is at least 3/4."""
    def side(k: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(k), F.col("shingles").alias(f"{k}_set"), F.col("bands").alias(f"{k}_bands"), F.col("sketches").alias(f"{k}_sketches"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    size = F.size("a_set") + F.size("b_set")
    low = F.least(F.col("a_bands")[0], F.col("b_bands")[0])  # the band that both take part in
    near = hamming(sketch_of(F.col("a_bands"), F.col("a_sketches"), low), sketch_of(F.col("b_bands"), F.col("b_sketches"), low)) * 7 <= size
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return both.where(F.when(F.coalesce(near, F.lit(False)), shared * 175 >= size * 75).otherwise(F.lit(False))).select("a", "b")


def kept_keys(rows: DataFrame) -> DataFrame:
    """(key, doc, n, band) of the keys that have to be compared, from one row per distinct set and band."""
    keys = rows.select(F.explode("keys").alias("key"), F.col("doc_id").alias("doc"), "n", "band", "need")
    by_key = Window.partitionBy("key")
    shared = keys.withColumn("g", F.count(F.lit(1)).over(by_key)).where("g > 1")
    by_doc = Window.partitionBy("doc", "band")
    ranked = (shared.withColumn("shared", F.count(F.lit(1)).over(by_doc))
              .withColumn("rank", F.row_number().over(by_doc.orderBy("g", "key"))))
    return ranked.where("shared >= need and rank <= shared - need + 1").select("key", "doc", "n", "band")


def similar_sizes(a: str, b: str) -> Column:
    return (F.col(a) * 4 >= F.col(b) * 3) & (F.col(b) * 4 >= F.col(a) * 3)


def first_pairs(kept: DataFrame) -> DataFrame:
    """Each document of a key with the key's first document and with its neighbour by size."""
    w = Window.partitionBy("key").orderBy("n", "doc")
    near = kept.select("doc", "n", F.lag("doc").over(w).alias("p"), F.lag("n").over(w).alias("pn"), F.first("doc").over(w).alias("f"), F.first("n").over(w).alias("fn"))
    both = near.select("doc", "n", F.explode(F.array(F.struct(F.col("p").alias("o"), F.col("pn").alias("on")), F.struct(F.col("f").alias("o"), F.col("fn").alias("on")))).alias("x"))
    return _pairs(both.select("doc", "n", "x.o", "x.on"))


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct (a < b) of (doc, n, o, on) rows with similar sizes."""
    return rows.where(F.col("o").isNotNull() & (F.col("o") != F.col("doc")) & similar_sizes("n", "on")).select(
        F.least("doc", "o").alias("a"), F.greatest("doc", "o").alias("b")).distinct()


def mixed_rows(kept: DataFrame, components: DataFrame) -> DataFrame:
    """(key, doc, n, band, component) of the keys in which more than one component meets.

    Keys with the same documents say the same; one of them stays.
    """
    marked = kept.join(components.withColumnRenamed("vertex", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    marked = cut(marked, "join_marked")
    members = [F.bit_xor(F.xxhash64("doc", F.lit(i))).alias(f"m{i}") for i in range(2)]
    ends = marked.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("rows"), F.min("band").alias("band"), *members)
    ends = ends.where("low < high").groupBy("rows", "band", "m0", "m1").agg(F.min("key").alias("key"))
    return cut(marked.join(ends.select("key"), "key", "left_semi"), "join_mixed")


def component_pairs(mixed: DataFrame) -> DataFrame:
    """Each document with the least and the greatest document of the other components at both ends of its key."""
    w = Window.partitionBy("key").orderBy("component", "doc")
    ends = Window.partitionBy("key").orderBy("component", "doc").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    near = mixed.select("doc", "n", "component", *[F.struct(f("doc").over(x).alias("o"), f("n").over(x).alias("on"), f("component").over(x).alias("oc")).alias(k)
                                                   for k, f, x in (("p", F.lag, w), ("f", F.first, ends), ("l", F.last, ends))])
    both = near.select("doc", "n", "component", F.explode(F.array("p", "f", "l")).alias("x")).select("doc", "n", "component", "x.*")
    return _pairs(both.where("oc <> component"))


def runs(batches, column: str):
    """Tables of the consecutive rows with one value of ``column``, across batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        values = b.column(column).to_numpy()
        edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1), len(values)]
        for i, j in zip(edges, edges[1:]):
            if held and held[-1].column(column)[0].as_py() != values[i]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def tile_rows(band: int) -> int:
    """Documents on each side of a tile: their sets stay within ``TILE_BYTES``, whatever their length."""
    return max(4, min(TILE, TILE_BYTES // (8 * limit(band))))


def near_pairs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of different components within the Hamming bound, in one tile."""
    doc, n, part, side = (rows.column(c).to_numpy() for c in ("doc", "n", "component", "side"))
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), "<u8").reshape(len(doc), -1)
    left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
    # documents of the largest component meet only the others
    common = np.bincount(np.unique(part, return_inverse=True)[1]).argmax()
    rare = np.flatnonzero(part != np.unique(part)[common])
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for x, y in ((np.intersect1d(left, rare), right), (np.setdiff1d(left, rare), np.intersect1d(right, rare))):
        step = max(1, BLOCK_BYTES // max(1, len(y) * sketch[0].nbytes))
        for at in range(0, len(x), step):
            i = x[at : at + step]
            far = np.bitwise_count(sketch[i][:, None, :] ^ sketch[y][None, :, :]).sum(-1, dtype=np.int64)
            size = n[i][:, None].astype(np.int64) + n[y][None, :]
            ok = (far * 7 <= size) & (part[i][:, None] != part[y][None, :]) & (4 * n[i][:, None] >= 3 * n[y][None, :]) & (4 * n[y][None, :] >= 3 * n[i][:, None])
            p, q = np.nonzero(ok)
            found.append((i[p], y[q]))
    return tuple(np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))


def _near(batches):
    """The rows of each tile that are within the Hamming bound of another component's row."""
    for rows in runs(batches, "tile"):
        near = np.unique(np.concatenate(near_pairs(rows)))
        if len(near):
            yield from rows.take(near).combine_chunks().to_batches()


def spanning_links(rows: pa.Table) -> list[tuple[int, int]]:
    """Verified links between the components of one tile: enough to connect what is connected, fewer than components."""
    doc, part = rows.column("doc").to_numpy(), np.unique(rows.column("component").to_numpy(), return_inverse=True)[1]
    sets = rows.column("shingles").combine_chunks()
    at = sets.offsets.to_numpy()
    flat = np.unique(sets.values.to_numpy()[at[0] : at[-1]], return_inverse=True)[1]
    at, n = at - at[0], np.diff(at).astype(np.int64)
    parent = np.arange(part.max() + 1)  # of the components

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    left, right = near_pairs(rows)
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    held, links_ = np.zeros(len(flat), bool), []
    edges = np.flatnonzero(np.diff(left, prepend=-1))
    for begin, end in zip(edges, np.r_[edges[1:], len(left)]):
        i = left[begin]
        others = right[begin:end]
        others = others[[root(part[j]) != root(part[i]) for j in others]]
        if not len(others):
            continue
        held[flat[at[i] : at[i + 1]]] = True
        ends = np.cumsum(n[others])
        shared = np.add.reduceat(held[np.concatenate([flat[at[j] : at[j + 1]] for j in others])].astype(np.int64), ends - n[others])
        held[flat[at[i] : at[i + 1]]] = False
        for j in others[shared * 7 >= (n[i] + n[others]) * 3]:
            p, q = root(part[i]), root(part[j])
            if p != q:
                parent[q] = p
                links_.append((min(doc[i], doc[j]), max(doc[i], doc[j])))
    return links_


def _linked(batches):
    for rows in runs(batches, "tile"):
        if found := spanning_links(rows):
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def tile_links(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links between components that meet in a key.

    A key's documents are dealt to blocks of bounded size; each pair of blocks is a tile. A first pass over the
    tiles compares dense sketches and keeps the documents within the Hamming bound of another
    component's; a second one checks their sets exactly. Neither makes rows of pairs: the first gives at most
    its own rows, the second fewer links than a tile has components.
    """
    most = F.element_at(F.array(*(F.lit(tile_rows(b)) for b in range(20))), F.least(F.col("band"), F.lit(19)) + 1)
    sizes = mixed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.min(most)).cast("int").alias("blocks"))
    dense = sets.select(F.col("doc_id").alias("doc"), F.explode(F.arrays_zip("bands", "packed")).alias("x")).select(
        "doc", F.col("x.bands").alias("band"), F.col("x.packed").alias("sketch"))
    rows = mixed.join(sizes, "key").join(dense, ["doc", "band"])
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(j, own).alias("i"), F.greatest(j, own).alias("j"), F.when(j == own, 3).when(own < j, 1).otherwise(2).alias("side")))
    dealt = rows.withColumn("t", F.explode(others)).select(F.xxhash64("key", "t.i", "t.j").alias("tile"), "doc", "n", "component", "t.side", "sketch")
    near = cut(dealt.repartition("tile").sortWithinPartitions("tile").mapInArrow(_near, dealt.schema), "join_near")
    exact = near.join(sets.select(F.col("doc_id").alias("doc"), "shingles"), "doc")
    return exact.repartition("tile").sortWithinPartitions("tile").mapInArrow(_linked, "a bigint, b bigint").distinct()


def chosen(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with (``left_semi``) or without (``left_anti``) the written distinct ``ids``."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", how)


def links(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Verified links (a, b) that connect every similar pair of distinct sets.

    ``rows`` has the keys of every distinct set and band, named by ``doc_id``.
    """
    kept = cut(kept_keys(rows), "join_keys")
    involved = cut(kept.select(F.col("doc").alias("doc_id")).distinct(), "join_involved")
    sets = cut(map_text(chosen(docs, involved, "left_semi"), _set_rows, SETS).dropDuplicates(["doc_id"]), "join_sets")
    done = cut(first_pairs(kept), "join_pairs")
    found = cut(verified(done, sets), "join_links")
    pairs = cut(component_pairs(mixed_rows(kept, connected_components(found))).join(done, ["a", "b"], "left_anti"), "join_pairs")
    found = found.union(cut(verified(pairs, sets), "join_links"))
    return found.union(cut(tile_links(mixed_rows(kept, connected_components(found)), sets), "join_links"))


def _print_rows(ids, texts):
    out = {"doc_id": ids, "n": [], "fp1": [], "fp2": []}
    with np.errstate(over="ignore"):
        for text in texts:
            s = shingles(text)
            for name, v in zip(("n", "fp1", "fp2"), (len(s), *fingerprint(s))):
                out[name].append(v)
    return out


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    same = ["fp1", "fp2", "n"]
    prints = cut(map_text(docs, _print_rows, "doc_id bigint, n bigint, fp1 bigint, fp2 bigint"), "join_prints")
    sets = cut(prints.where("n > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "join_distinct")
    # Of equal sets only the least document's keys are joined. Both sides are plain exchanges, so a hot set can be split.
    copies = cut(prints.join(sets.where("copies > 1"), same).where("doc_id <> rep").select("doc_id").distinct(), "join_copies")
    rows = map_text(chosen(docs.where("doc_id is not null"), copies, "left_anti"), _sketch_rows, ROWS)
    parts = connected_components(links(docs, rows)).withColumnRenamed("vertex", "rep")
    known = cut(sets.join(parts, "rep", "left").where("copies > 1 or component is not null").select(
        *same, F.coalesce("component", "rep").alias("component")), "join_classes")
    return prints.join(known, same, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that with the least ``doc_id``. Rows without a ``doc_id`` stay."""
    found = cut(classes(docs), "join_found").where("doc_id is not null")
    gone = found.where("doc_id <> component_id").select("doc_id")
    again = cut(found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id"), "join_repeated")
    if again.isEmpty():
        return chosen(docs, cut(gone.distinct(), "join_gone"), "left_anti").select(docs.columns)
    once = docs.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return docs.join(gone.union(again), "doc_id", "left_anti").select(docs.columns).union(once.select(docs.columns))
