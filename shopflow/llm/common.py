"""Helpers shared by the operators: shared work tables, Arrow maps, and code shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.session import work_path

#: Rows of whole texts in one Arrow batch. It bounds a Python worker's memory, not the work.
BATCH_ROWS = 2048
#: Bytes of one Arrow batch, but for a longer single row.
BATCH_BYTES = 16 << 20
#: Space, tab, line feed, vertical tab, form feed, carriage return: the white space between words.
WHITE = " \t\n\x0b\x0c\r"
WHITE_CLASS = r"[\x20\x09-\x0D]"

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the Python workers and bound their Arrow batches.

    The package is zipped once per application and added with ``addPyFile``,
    so executors without a checkout of the repository can run the operators.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="shopflow-zip-"), "shopflow_llm.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, names in os.walk(root):
                for n in names:
                    if n.endswith(".py"):
                        p = os.path.join(folder, n)
                        z.write(p, os.path.join("shopflow", os.path.relpath(p, root)))
        sc.addPyFile(target)
        _SHIPPED.add(sc.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def cut(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet table in the shared folder and read it back.

    This cuts the lineage and survives the loss of executors. The schema is
    passed on, so the reread starts no inference job.
    """
    path = work_path(df.sparkSession, "llm", name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a narrow table (some hundred bytes each at most) up to which it is broadcast.
SMALL_ROWS = 100_000


def small(df: DataFrame) -> DataFrame:
    """A written table, broadcast in joins if its counted rows allow it, so the large side is not dealt by a hot key."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def map_text(df: DataFrame, fn, schema: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Apply ``fn(keys, texts) -> {column: values}`` to Arrow batches of (key, text).

    Null texts reach ``fn`` as empty strings.
    """
    out = schema_of(df.sparkSession, schema)

    def run(batches):
        for b in batches:
            if b.num_rows:
                got = fn(b.column(0), [t or "" for t in b.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([_column(got[n], t) for n, t in out], [n for n, _ in out])

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def _column(values, kind):
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def schema_of(spark: SparkSession, ddl: str) -> list[tuple[str, pa.DataType]]:
    """(name, Arrow type) of a DDL schema string."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    return [(f.name, to_arrow_type(f.dataType)) for f in StructType.fromDDL(ddl).fields]


def words(col):
    """Native word array of a text column; null gives an empty array."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), WHITE_CLASS + "+"), lambda w: w != "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
