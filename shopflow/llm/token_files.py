"""Token-id files: Parquet list columns with chosen encodings, row groups and page indexes.

Documents are range-partitioned and sorted by ``doc_id``, tokenized, and
written by Spark's Parquet writer as (shard, doc_id, n_tokens, tokens). The
token list is dictionary-coded (or delta-coded), the metadata columns are
delta-coded, row groups and pages are small, and each file carries column and
offset indexes, so a filter on ``doc_id`` reads few pages and a metadata read
touches no token page. ``shard`` numbers the files in ``doc_id`` order.

Defined results: null text has only the end id. A null ``doc_id`` sorts first.
Rows with the same ``doc_id`` each stay; their order is by token count, then
checksum. Other columns are not written. An empty table gives no rows. Starts are
sums of 64-bit integers over two levels (shards, then rows of a shard), so no
task sees all rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.llm.common import ship
from shopflow.llm.tokens import END_ID, batch_ids, vocabulary_path
from shopflow.session import work_path

FILE_SCHEMA = "shard int, doc_id bigint, n_tokens bigint, tokens array<int>"
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 1000


def writer_options(encoding: str = "dictionary", row_group_bytes: int = ROW_GROUP_BYTES,
                   page_bytes: int = PAGE_BYTES, page_rows: int = PAGE_ROWS) -> dict[str, str]:
    """Options of the Parquet writer for one token encoding, ``dictionary`` or ``delta``."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown token encoding: {encoding}")
    return {
        "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#tokens.list.element": "true" if encoding == "dictionary" else "false",
        "parquet.block.size": str(row_group_bytes), "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
    }


def write_tokens(docs: DataFrame, path: str, *, vocabulary: str | None = None, end_id: int = END_ID, **options) -> None:
    """Tokenize ``docs`` (doc_id, text) and write the token files to ``path``."""
    ship(docs.sparkSession)
    vocabulary = vocabulary or vocabulary_path()

    def run(batches):
        for b in batches:
            if b.num_rows:
                ids, ends = batch_ids(b.column(2), vocabulary, end_id)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(ends, prepend=0)), lists], ["shard", "doc_id", "n_tokens", "tokens"])

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
               .sortWithinPartitions("doc_id").select(F.spark_partition_id().alias("shard"), "doc_id", "text"))
    ordered.mapInArrow(run, FILE_SCHEMA).write.options(**writer_options(**options)).parquet(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The files as a DataFrame; ``doc_ids`` is pushed down to the page indexes."""
    df = spark.read.schema(FILE_SCHEMA).parquet(path)
    return df if doc_ids is None else df.where(F.col("doc_id").isin(*doc_ids))


def digests(files: DataFrame) -> DataFrame:
    """Per document: the ids before it, its number of ids and their checksum, all from the files."""
    ship(files.sparkSession)

    def run(batches):
        for b in batches:
            if b.num_rows:
                c = b.column(2)
                at, flat = c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    b.column(0), b.column(1), pa.array(np.diff(at).astype(np.int64)),
                    pa.array([zlib.crc32(flat[i:j].astype("<u4").tobytes()) for i, j in zip(at, at[1:])], pa.int64())],
                    ["shard", "doc_id", "n_tokens", "ids_crc32"])

    rows = files.select("shard", "doc_id", "tokens").mapInArrow(run, "shard int, doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    # One row per file, so the running sum over all files is small whatever the number of documents.
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("shard").orderBy("doc_id", "n_tokens", "ids_crc32").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.join(F.broadcast(shards), "shard")
            .select("doc_id", (F.col("before") + F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32"))


def token_table(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the files (to a fresh folder below the shared one unless ``path`` is given) and digest them."""
    path = path or work_path(docs.sparkSession, "llm", "tokens")
    write_tokens(docs, path, **options)
    return digests(read_tokens(docs.sparkSession, path))
