"""Prefix trie of conversations, summed by the Euler-tour technique.

Turns are sorted by range partitions, so a long conversation is spread over
tasks. Each task keeps running polynomial hashes (128 bits) of its turns, and what
conversations over a partition's edge bring along is added from one or two summary rows
a partition. Since the hash of turns i..j follows from two prefix hashes, rebuilt
conversations get theirs from the originals' without another sort.

A node is a distinct prefix. Each has an enter and an exit arc; an enter arc is followed
by the first child's or its own exit arc, an exit arc by the next sibling's enter arc or
the parent's exit arc. The tour is list-ranked distributedly: nodes lie in range
partitions by their least conversation, so paths and neighbouring siblings are near each
other, each task shortens the pieces of the tour inside it, and the pieces are ranked by
pointer jumping over the whole cluster. Ranks carry the number of arcs, leaves and saved tokens
up to the tour's end; a subtree's sums are those at its enter arc less those at its exit arc.

No conversation, parent or node is collected in one task: siblings are found in range
partitions, and the ids for a node's checksum come as one piece of text a partition.

Defined results: rows without a ``conv_id`` are left out; a null turn comes first; turns
with equal numbers are ordered by role and text; repeated rows are turns of their own.
Null role or text is empty. Other columns are ignored. An empty table gives no nodes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import cut, ship, small
from shopflow.llm.ngram_join import mix

#: A conversation takes over turns of the first one of its group; the number is below ``SHARED``.
GROUP, SHARED = 5, 9
#: Rows of one task, on average, beyond ``spark.sql.shuffle.partitions`` tasks.
TASK_ROWS = 200_000
U64, MASK = np.uint64, 2**64 - 1
#: Odd bases of the two polynomial hashes, and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(r, -1, 2**64) for r in BASES)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def tasks(df: DataFrame) -> int:
    """Tasks for the rows of a written table."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // TASK_ROWS))


def ranged(df: DataFrame, n: int, *by: str) -> DataFrame:
    """Sorted range partitions with their number ``pid``."""
    return df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("pid", F.spark_partition_id())


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    return np.cumprod(np.r_[U64(1), np.full(n, base, U64)], dtype=U64)


def u64(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(U64)


def i64(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == U64 else values.astype(np.int64))


TURNS = "pid int, conv_id bigint, j bigint, o1 bigint, o2 bigint, e1 bigint, e2 bigint, bytes bigint, edge boolean"


def _running(batches):
    """Number and prefix hashes of each turn within its conversation's rows of this partition.

    ``edge`` marks the last rows here of the partition's first and last conversation.
    """
    names = [f.split()[0] for f in TURNS.split(", ")]
    held, first, conv, j, o = None, None, None, 0, [U64(0), U64(0)]
    with np.errstate(over="ignore"):
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("conv_id").to_numpy()
            new = np.r_[ids[0] != conv, ids[1:] != ids[:-1]]
            if first is None:
                first = ids[0]
            if held is not None:
                held[-1][-1] = bool(new[0]) and held[1][-1] == first
                yield _turn_batch(held, names)
            begins = np.maximum.accumulate(np.where(new, np.arange(len(ids)), -1))  # -1: goes on from the batch before
            number = np.where(begins >= 0, np.arange(len(ids)) - begins + 1, np.arange(len(ids)) + 1 + j)
            scale, out = [], []
            for k in (0, 1):
                e = u64(b.column(f"x{k + 1}")) * powers(BASES[k], int(number.max()))[number]
                total = np.cumsum(e, dtype=U64)
                before = np.where(begins >= 0, total[begins] - e[begins], U64(0) - o[k])
                scale.append(e)
                out.append(total - before)
            edge = np.r_[new[1:], False] & (ids == first)
            held = [b.column("pid"), ids, number, *out, *scale, b.column("bytes"), edge]
            conv, j, o = ids[-1], int(number[-1]), [x[-1] for x in out]
        if held is not None:
            held[-1][-1] = True
            yield _turn_batch(held, names)


def _turn_batch(held, names):
    pid, *numbers, size, edge = held
    return pa.RecordBatch.from_arrays([pid, *map(i64, numbers), size, pa.array(edge)], names)


def carried(edges: list) -> dict[int, tuple]:
    """pid -> (conversation, turns, prefix hashes) that its first conversation had in earlier partitions."""
    out, held = {}, None
    by_pid: dict[int, list] = {}
    for r in sorted(edges, key=lambda r: (r.pid, r.conv_id, r.j)):
        by_pid.setdefault(r.pid, []).append(r)
    for pid, rows in by_pid.items():
        for r in rows:
            total = (r.conv_id, r.j, r.o1 & MASK, r.o2 & MASK)
            if held and held[0] == r.conv_id:
                if r is rows[0]:
                    out[pid] = held
                n = held[1]
                total = (r.conv_id, n + r.j, *((h + pow(base, n, 2**64) * x) & MASK for h, base, x in zip(held[2:], BASES, total[2:])))
            held = total
    return out


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, j, o1, o2, e1, e2, bytes): each original turn's number, prefix hashes up to it, its own terms, and its text's bytes."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text")).where("conv_id IS NOT NULL")
    ordered = ranged(rows, tasks(rows), "conv_id", "turn", "role", "text").select(
        "pid", "conv_id", F.xxhash64("role", "text").alias("x1"), F.xxhash64(F.lit(1), "text", "role").alias("x2"),
        F.octet_length("text").cast("long").alias("bytes"))
    turns = cut(ordered.mapInArrow(_running, TURNS), "trie_turns")
    carry = carried(turns.where("edge").select("pid", "conv_id", "j", "o1", "o2").collect())  # two rows a partition at most

    def resolve(batches):
        with np.errstate(over="ignore"):
            for b in batches:
                if not b.num_rows:
                    continue
                pid, ids = b.column("pid").to_numpy(), b.column("conv_id").to_numpy()
                j, *hashes = b.column("j").to_numpy().copy(), *(u64(b.column(c)).copy() for c in ("o1", "o2", "e1", "e2"))
                for p in np.unique(pid):
                    if p in carry:
                        conv, n, *before = carry[p]
                        on = (pid == p) & (ids == conv)
                        j[on] += n
                        for k in (0, 1):
                            factor = U64(pow(BASES[k], n, 2**64))
                            hashes[k][on] = U64(before[k]) + factor * hashes[k][on]
                            hashes[k + 2][on] *= factor
                yield pa.RecordBatch.from_arrays([b.column("conv_id"), i64(j), *map(i64, hashes), b.column("bytes")],
                                                 ["conv_id", "j", "o1", "o2", "e1", "e2", "bytes"])

    return turns.mapInArrow(resolve, "conv_id bigint, j bigint, o1 bigint, o2 bigint, e1 bigint, e2 bigint, bytes bigint")


MEMBERS = "conv_id bigint, depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, bytes bigint, ends boolean"


def _keys(batches):
    """Node and parent keys: the hash of the rebuilt prefix, with its depth mixed in."""
    inverse = [np.array([pow(r, s, 2**64) for s in range(SHARED)], U64) for r in INVERSES]
    with np.errstate(over="ignore"):
        for b in batches:
            if not b.num_rows:
                continue
            depth, shift = u64(b.column("depth")), b.column("shift").to_numpy()
            keys, parents = [], []
            for k in (0, 1):
                factor = inverse[k][shift]
                key = u64(b.column(f"b{k + 1}")) + factor * (u64(b.column(f"o{k + 1}")) - u64(b.column(f"c{k + 1}")))
                keys.append(mix(key + mix(depth, 71), k + 1))
                parents.append(mix(key - factor * u64(b.column(f"e{k + 1}")) + mix(depth - U64(1), 71), k + 1))
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("depth"), *map(i64, keys), *map(i64, parents), b.column("bytes"), b.column("ends")],
                                             ["conv_id", "depth", "k1", "k2", "p1", "p2", "bytes", "ends"])


def members(conversations: DataFrame) -> DataFrame:
    """One row per rebuilt conversation and prefix, the empty one included, with the keys of its node and of the parent."""
    turns = cut(numbered_turns(conversations), "trie_numbered")
    convs = cut(turns.groupBy("conv_id").agg(F.max("j").alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).alias("h")), "trie_convs")
    heads = cut(turns.where(F.col("j") < SHARED), "trie_heads")
    taken = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left").withColumn(
        "m", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))))

    def prefix(key: str, number: str, name: str) -> DataFrame:
        return heads.select(F.col("conv_id").alias(key), F.col("j").alias(number), F.col("o1").alias(f"{name}1"), F.col("o2").alias(f"{name}2"))

    none = F.lit(0).cast("long")
    info = cut(taken.join(prefix("base", "m", "b"), ["base", "m"], "left").join(prefix("conv_id", "h", "c"), ["conv_id", "h"], "left").select(
        "conv_id", "base", "h", "m", *(F.coalesce(c, none).alias(c) for c in ("b1", "b2", "c1", "c2")),
        (F.col("m") + F.greatest(F.col("n") - F.col("h"), none)).alias("total")), "trie_info")

    def rows(df: DataFrame, depth, shift, own: bool) -> DataFrame:
        return df.select("conv_id", depth.alias("depth"), shift.alias("shift"), *((F.col(c) if own else none).alias(c) for c in ("b1", "b2", "c1", "c2")),
                         "o1", "o2", "e1", "e2", "bytes", (depth == F.col("total")).alias("ends"))

    shared = rows(info.join(heads.withColumnRenamed("conv_id", "base"), "base").where("j <= m"), F.col("j"), none, False)
    own = rows(turns.join(small(info), "conv_id").where("j > h"), F.col("j") - F.col("h") + F.col("m"), F.col("h") - F.col("m"), True)
    root = rows(info.withColumns({c: none for c in ("o1", "o2", "e1", "e2", "bytes")}), none, none, False)
    return cut(shared.union(own).union(root).mapInArrow(_keys, MEMBERS), "trie_members")


ENDS = "k1 bigint, k2 bigint, pid int, edge boolean, ids string, sha string"


def _pieces(batches):
    """The comma-joined ids of each node in this partition; nodes at its edges may go on elsewhere, others get their checksum."""
    node, ids, first = None, [], True

    def row(edge: bool):
        text = ",".join(ids)
        return (*node, pid, edge, text if edge else None, None if edge else hashlib.sha256(text.encode()).hexdigest())

    for b in batches:
        out = []
        for k1, k2, conv, pid in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "conv_id", "pid"))):
            if (k1, k2) != node:
                if node is not None:
                    out.append(row(first))
                    first = False
                node, ids = (k1, k2), []
            ids.append(str(conv))
        if out:
            yield _rows(out, ENDS)
    if node is not None:
        yield _rows([row(True)], ENDS)


def _whole(batches):
    """Checksums over the pieces of one node after another."""
    node, digest = None, None
    for b in batches:
        out = []
        for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if (k1, k2) != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (k1, k2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield _rows(out, "k1 bigint, k2 bigint, sha string")
    if node is not None:
        yield _rows([(*node, digest.hexdigest())], "k1 bigint, k2 bigint, sha string")


def _rows(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


def end_checksums(rows: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes at which conversations end."""
    ends = rows.where("ends").select("k1", "k2", "conv_id")
    pieces = cut(ranged(ends, tasks(ends), "k1", "k2", "conv_id").mapInArrow(_pieces, ENDS), "trie_ends")
    parts = pieces.where("edge").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "pid").mapInArrow(_whole, "k1 bigint, k2 bigint, sha string")
    return pieces.where("NOT edge").select("k1", "k2", "sha").union(parts).withColumnRenamed("sha", "ends_sha256")


SIBLINGS = "pid int, id bigint, parent bigint, parent_conv_id bigint, next bigint, edge boolean"


def _siblings(batches):
    """The next row's id where it has the same parent; ``edge`` marks the partition's first and last row."""
    held, first = None, True

    def done(b, following):
        ids, parents = b.column("id").to_numpy(), b.column("parent").to_numpy()
        after = np.r_[ids[1:], following[0]], np.r_[parents[1:], following[1]]
        edge = np.zeros(len(ids), bool)
        edge[0], edge[-1] = first, following[0] < 0
        return pa.RecordBatch.from_arrays([b.column("pid"), b.column("id"), b.column("parent"), b.column("parent_conv_id"),
                                           pa.array(after[0], mask=after[1] != parents), pa.array(edge)], ["pid", "id", "parent", "parent_conv_id", "next", "edge"])

    for b in batches:
        if b.num_rows:
            if held is not None:
                yield done(held, (b.column("id")[0].as_py(), b.column("parent")[0].as_py()))
                first = False
            held = b
    if held is not None:
        yield done(held, (-1, -1))


def siblings(nodes: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """(id, parent, parent_conv_id, next) of every node but the root, and the next siblings that lie in another partition."""
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    kids = cut(nodes.where("depth > 0").select("id", "conv_id", "p1", "p2").join(parents, ["p1", "p2"]).select("id", "conv_id", "parent", "parent_conv_id"), "trie_kids")
    rows = cut(ranged(kids, tasks(kids), "parent", "conv_id").mapInArrow(_siblings, SIBLINGS), "trie_siblings")
    edges = sorted(rows.where("edge").select("pid", "parent", "id").collect())  # two rows a partition at most
    over = {a.id: b.id for a, b in zip(edges, edges[1:]) if a.pid < b.pid and a.parent == b.parent}
    return rows.drop("pid", "edge"), over


SUMS = ("arcs", "leaves", "saved")
KEPT = ("id", "conv_id", "depth", "k1", "k2", "n_convs", "parent_conv_id", "n_children")
TOUR = ", ".join([*(f"{c} bigint" for c in KEPT), *(f"{side}_{c} bigint" for side in ("enter", "exit") for c in (*SUMS, "out")), "enter_head boolean", "exit_head boolean"])


def shortened(table: pa.Table, over: dict[int, int]) -> pa.RecordBatch:
    """Sums of every arc of some nodes up to the end of the tour's piece among them, and the arc outside that follows the piece."""
    table = table.sort_by("id")
    ids = table.column("id").to_numpy()
    n = len(ids)

    def known(name: str) -> np.ndarray:
        return table.column(name).combine_chunks().fill_null(-1).to_numpy(zero_copy_only=False)

    child, sibling, parent = known("first_child"), known("next"), known("parent")
    if over:
        for i in np.flatnonzero(np.isin(ids, list(over))):
            sibling = sibling.copy() if not sibling.flags.writeable else sibling
            sibling[i] = over[int(ids[i])]
    following = np.empty(2 * n, np.int64)
    following[0::2] = np.where(child >= 0, 2 * child, 2 * ids + 1)
    following[1::2] = np.where(sibling >= 0, 2 * sibling, np.where(parent >= 0, 2 * parent + 1, -1))
    at = np.minimum(np.searchsorted(ids, following >> 1), n - 1)
    inside = (following >= 0) & (ids[at] == following >> 1)
    pointer = np.where(inside, 2 * at + (following & 1), -1)
    head = np.ones(2 * n, bool)
    head[pointer[inside]] = False
    sums = np.zeros((3, 2 * n), np.int64)
    sums[0] = 1
    sums[1, 0::2] = child < 0
    sums[2, 0::2] = known("tokens")
    tail = np.arange(2 * n)
    while len(live := np.flatnonzero(pointer >= 0)):
        to = pointer[live]
        added, ends, jumps = sums[:, to], tail[to], pointer[to]
        sums[:, live] += added
        tail[live], pointer[live] = ends, jumps
    out = following[tail]
    columns = [table.column(c).combine_chunks() for c in KEPT]
    for side in (0, 1):
        o = out[side::2]
        columns += [*(pa.array(s[side::2]) for s in sums), pa.array(o, mask=o < 0)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(head[0::2]), pa.array(head[1::2])], [f.split()[0] for f in TOUR.split(", ")])


def ranked(pieces: DataFrame) -> DataFrame:
    """(arc, arcs, leaves, saved) up to the tour's end of every piece (arc, out, ...), by pointer jumping.

    The pieces form one list, so no two of them point to the same one.
    """
    pieces = cut(pieces, "trie_pieces")
    while not pieces.where("out IS NOT NULL").isEmpty():
        far = pieces.select(F.col("arc").alias("out"), F.col("out").alias("far"), *(F.col(c).alias(f"far_{c}") for c in SUMS))
        pieces = cut(pieces.join(far, "out", "left").select(
            "arc", F.col("far").alias("out"), *((F.col(c) + F.coalesce(f"far_{c}", F.lit(0))).alias(c) for c in SUMS)), "trie_pieces")
    return pieces.drop("out")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the places
    of its arcs on the tour (enter, exit; the root enters at 0)."""
    ship(conversations.sparkSession)
    rows = members(conversations)
    distinct = cut(rows.groupBy("k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("bytes").alias("bytes")), "trie_distinct")
    n = tasks(distinct)
    nodes = cut(ranged(distinct, n, "conv_id", "depth").withColumn("id", F.monotonically_increasing_id()).drop("pid"), "trie_nodes")
    next_ones, over = siblings(nodes)
    first = next_ones.join(nodes.select("id", "conv_id"), "id").groupBy("parent").agg(
        F.min(F.struct("conv_id", "id")).alias("least"), F.count(F.lit(1)).alias("n_children")).select(F.col("parent").alias("id"), F.col("least.id").alias("first_child"), "n_children")
    links = cut(nodes.join(first, "id", "left").join(next_ones, "id", "left").select(
        "id", "conv_id", "depth", "k1", "k2", "n_convs", "parent_conv_id", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        "first_child", "next", "parent", ((F.col("n_convs") - 1) * F.col("bytes")).alias("tokens")), "trie_links")

    def tour(batches):
        held = [b for b in batches if b.num_rows]  # one range partition of about TASK_ROWS narrow rows
        if held:
            yield shortened(pa.Table.from_batches(held), over)

    arcs = cut(links.repartitionByRange(n, "id").mapInArrow(tour, TOUR), "trie_arcs")
    pieces = None
    for side, odd in (("enter", 0), ("exit", 1)):
        heads = arcs.where(f"{side}_head").select((F.col("id") * 2 + odd).alias("arc"), F.col(f"{side}_out").alias("out"), *(F.col(f"{side}_{c}").alias(c) for c in SUMS))
        pieces = heads if pieces is None else pieces.union(heads)
    ranks = ranked(pieces)
    for side in ("enter", "exit"):
        rest = ranks.select(F.col("arc").alias(f"{side}_out"), *(F.col(c).alias(f"{side}_{c}_rest") for c in SUMS))
        arcs = arcs.join(small(rest), f"{side}_out", "left").withColumns({f"{side}_{c}": F.col(f"{side}_{c}") + F.coalesce(f"{side}_{c}_rest", F.lit(0)) for c in SUMS})
    length = 2 * nodes.count()
    return arcs.join(end_checksums(rows), ["k1", "k2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("enter_leaves") - F.col("exit_leaves")).alias("n_leaves"),
        (F.col("enter_saved") - F.col("exit_saved")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        (F.lit(length) - F.col("enter_arcs")).alias("enter"), (F.lit(length) - F.col("exit_arcs")).alias("exit"))


def report(nodes: DataFrame) -> DataFrame:
    """The nodes without their places on the tour."""
    return nodes.drop("enter", "exit")


SQL = r"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS j
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
             lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
r AS (
  SELECT c.conv_id, 0 AS part, o.j, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.j <= c.h
  UNION ALL SELECT c.conv_id, 1, o.j, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.j > c.h),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, j) AS d, role, text FROM r),
s AS (
  SELECT conv_id, d, strlen(text) AS bytes,
         sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM t
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
p AS (SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY d) AS pk, max(d) OVER (PARTITION BY conv_id) AS total FROM s),
n AS (
  SELECT d, k, min(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = total), '')) AS ends FROM p GROUP BY d, k),
q AS (SELECT n.*, coalesce(x.kids, 0) AS kids FROM n LEFT JOIN (SELECT d - 1 AS d, pk AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL) x USING (d, k)),
b AS (
  SELECT p.d, p.k, count(*) FILTER (q.kids = 0) AS n_leaves, sum((q.n_convs - 1) * q.bytes) AS saved
  FROM q JOIN p ON p.conv_id = q.conv_id AND p.d <= q.d GROUP BY p.d, p.k)
SELECT q.conv_id, CAST(q.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, q.n_convs, CAST(q.kids AS BIGINT) AS n_children, b.n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, q.ends AS ends_sha256
FROM q JOIN b USING (d, k) LEFT JOIN n u ON u.d = q.d - 1 AND u.k = q.pk
"""
