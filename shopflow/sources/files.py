"""File and stream sources, always with a fixed schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.schemas import CORRUPT, MESSAGE, with_corrupt


# Default bounds of one micro-batch.
OFFSETS_PER_TRIGGER = 1_000_000
FILES_PER_TRIGGER = 64


def read_csv(spark: SparkSession, path, schema: T.StructType, header: bool = True,
             corrupt_col: str | None = CORRUPT, encoding: str = "UTF-8",
             **options) -> DataFrame:
    """CSV with header and a fixed schema.

    Rows that do not fit the schema are kept, with the raw line in
    ``corrupt_col`` (PERMISSIVE).  A UTF-8 byte-order mark at the start of
    the file is skipped by the reader.
    """
    reader = (spark.read.option("header", header).option("mode", "PERMISSIVE")
              .option("encoding", encoding))
    if corrupt_col:
        schema = with_corrupt(schema) if corrupt_col not in schema.fieldNames() else schema
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.schema(schema).csv(path)


def read_csv_dir(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """Read back a folder of Spark-written CSV parts (all parts)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def read_json(spark: SparkSession, path, schema: T.StructType,
              multiline: bool = True, corrupt_col: str | None = CORRUPT) -> DataFrame:
    """JSON.  ``multiline=True`` reads files holding one JSON array (or
    object) each -- one task per file; ``multiline=False`` reads JSON Lines,
    split by the reader, which is the form that scales for one big input."""
    reader = spark.read.option("multiLine", multiline).option("mode", "PERMISSIVE")
    if corrupt_col:
        schema = with_corrupt(schema) if corrupt_col not in schema.fieldNames() else schema
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).json(path)


def read_lines(spark: SparkSession, path) -> DataFrame:
    """S3: one row per text line, column ``value``."""
    return spark.read.text(path)


def read_xml_nested(spark: SparkSession, path, row_tag: str, schema: T.StructType,
                    array_path: str, columns: dict[str, str],
                    outer: bool = False) -> DataFrame:
    """Nested XML -> one row per element of ``array_path``.

    ``columns`` maps output name -> path, where a path starting with ``item.``
    refers to a field of the exploded element and any other path to a field
    of the row element.  The file is split and parsed on the executors.
    Records that do not fit the schema are in ``rejected_xml``.
    """
    raw = _xml(spark, path, row_tag, schema, "DROPMALFORMED")
    explode = F.explode_outer if outer else F.explode
    rows = raw.select("*", explode(F.col(array_path)).alias("item"))
    return rows.select(*[F.col(p).alias(n) for n, p in columns.items()])


def _xml(spark: SparkSession, path, row_tag: str, schema: T.StructType, mode: str) -> DataFrame:
    """XML records without the text of broken ones: for each of those the reader would read its file again up to there."""
    return spark.read.format("xml").option("rowTag", row_tag).option("mode", mode).schema(schema).load(path)


def rejected_xml(spark: SparkSession, path, row_tag: str, schema: T.StructType) -> DataFrame:
    """The XML records that do not fit the schema, as far as they parsed: all records, broken ones as far as
    they parsed, less those that fit."""
    # every field is compared, so every field is parsed and checked
    return _xml(spark, path, row_tag, schema, "PERMISSIVE").exceptAll(_xml(spark, path, row_tag, schema, "DROPMALFORMED"))


def read_parquet(spark: SparkSession, path, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet (column pruning and filter pushdown come from Catalyst)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def register(df: DataFrame, name: str) -> None:
    """Make a DataFrame visible to spark.sql under ``name``."""
    df.createOrReplaceTempView(name)


def read_stream(spark: SparkSession, fmt: str, options: dict | None = None,
                path: str | None = None, schema: T.StructType | None = None,
                per_trigger: int | None = None) -> DataFrame:
    """A message stream -> columns key, value (strings), timestamp.

    ``fmt="kafka"`` needs the Kafka connector on the classpath; any file
    format with the same three columns (parquet, json) serves as a stand-in.
    Starting offsets default to the earliest available data.  A trigger takes
    at most ``per_trigger`` offsets (Kafka) or files, so the first batch over a
    long topic stays bounded.
    """
    reader = spark.readStream.format(fmt)
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        opts.setdefault("maxOffsetsPerTrigger", str(per_trigger or OFFSETS_PER_TRIGGER))
    else:
        opts.setdefault("maxFilesPerTrigger", str(per_trigger or FILES_PER_TRIGGER))
        reader = reader.schema(schema or MESSAGE)
    for k, v in opts.items():
        reader = reader.option(k, v)
    raw = reader.load(path) if path else reader.load()
    return raw.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"),
                      F.col("timestamp").cast("timestamp").alias("timestamp"))
