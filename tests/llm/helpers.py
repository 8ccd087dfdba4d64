"""Documents with awkward rows, shared by the operators' tests."""

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
PROSE = "The quick brown fox jumps over the lazy dog while seven other animals watch from the hill and wait for rain."
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))


def awkward(spark, extra=True):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    rows = [
        (1, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (3, None, "en", "a", None), (4, "", None, "b", 0),
        (5, " \n\t ", "de", None, 4), (6, LONG, "en", "a", len(LONG)), (None, PROSE, None, None, None), (7, "one", "fr", "c", 3),
        (8, "émigré naïve 日本語 token = \"abcdef0123456789abcdef01\"", "fr", "c", 9), (9, PROSE.upper() + " Extra.", "en", "a", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(i) for i, c in enumerate(("n_words", "kept", "key", "spans", "n", "tokens", "part", "score", "rank", "shard", "weight"))})
    return df


def nothing(spark):
    return spark.createDataFrame([], DOCS)
