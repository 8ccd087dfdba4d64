"""Activity-log counting with column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.columns import LOG_SYSTEM_WORD

CUSTOMER_PATTERN = r"(?<![A-Za-z0-9])C[0-9]+(?![A-Za-z0-9])"


def count_log_events(lines: DataFrame, words: Mapping[str, str],
                     id_pattern: str = CUSTOMER_PATTERN, key: str = "cliente_id",
                     exclude: str = LOG_SYSTEM_WORD, min_tokens: int = 3) -> DataFrame:
    """Per-customer count of lines holding each event word, in one pass.

    ``words`` maps event word -> output column.  A line counts for a word
    when one of its whitespace tokens *equals* the word (a title that merely
    contains it does not); lines holding ``exclude`` and lines with fewer
    than ``min_tokens`` tokens are skipped; the customer is the first token
    matching ``id_pattern``, wherever it stands.  Partial aggregation keeps
    a very active customer from piling up in one task.
    """
    toks = F.split(F.trim(F.col("value")), r"\s+")
    df = (lines.filter(~F.col("value").contains(exclude))
               .withColumn("__toks", toks)
               .filter(F.size("__toks") >= min_tokens)
               .withColumn(key, F.regexp_extract(F.col("value"), id_pattern, 0))
               .filter(F.col(key) != ""))
    hits = {out: F.array_contains("__toks", w) for w, out in words.items()}
    df = df.select(key, *[h.alias(o) for o, h in hits.items()])
    any_hit = None
    for o in hits:
        any_hit = F.col(o) if any_hit is None else (any_hit | F.col(o))
    df = df.filter(any_hit)
    return df.groupBy(key).agg(*[F.count_if(F.col(o)).alias(o) for o in hits])


def log_activity(lines: DataFrame) -> DataFrame:
    """Purchases and sessions (LOGIN) per customer."""
    return count_log_events(lines, {"PURCHASE": "compras_en_log", "LOGIN": "sesiones_log"})
