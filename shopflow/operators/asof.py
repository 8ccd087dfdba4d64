"""J7/P8 as of event time: validity intervals of a dimension, and the join that picks the version of the moment.

``versions`` turns successive deliveries into intervals [desde, hasta); ``disjoint``
cuts overlapping intervals so that the one that began last holds; ``as_of_join``
joins facts by key and time. Both sides are dealt by (key, time bucket), so a
key with a third of all facts is spread over its buckets; a version is repeated for
each bucket that it covers between the first and the last fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FROM, TO = "desde", "hasta"


def versions(deliveries: DataFrame, key: str, time: str, fields: Sequence[str]) -> DataFrame:
    """(key, fields, desde, hasta) from rows (key, time, fields) of successive deliveries.

    A delivery that repeats a key's values opens no version; of rows with equal key and time the
    greatest by its fields holds. The last version is open (null ``hasta``). Null keys or times are left out.
    """
    rows = deliveries.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    one = rows.groupBy(key, F.col(time).alias(FROM)).agg(F.max(F.struct(*fields)).alias("_v"))
    by_time = Window.partitionBy(key).orderBy(FROM)  # one row per key and delivery
    changed = one.withColumn("_p", F.lag("_v").over(by_time)).where(F.col("_p").isNull() | ~F.col("_v").eqNullSafe(F.col("_p")))
    return changed.select(key, *(F.col("_v")[f].alias(f) for f in fields), FROM, F.lead(FROM).over(by_time).alias(TO))


def disjoint(intervals: DataFrame, key: str) -> DataFrame:
    """Intervals without overlaps: at each moment the one that began last holds (ties: the greatest by its columns)."""
    rows = intervals.where(F.col(TO).isNull() | (F.col(TO) > F.col(FROM)))
    values = [c for c in rows.columns if c not in (key, FROM, TO)]
    edges = rows.select(key, F.col(FROM).alias("_a")).union(rows.where(F.col(TO).isNotNull()).select(key, TO)).distinct()
    pieces = edges.withColumn("_z", F.lead("_a").over(Window.partitionBy(key).orderBy("_a")))
    cover = pieces.join(rows, key).where((F.col(FROM) <= F.col("_a")) & (F.col(TO).isNull() | (F.col(TO) > F.col("_a"))))
    held = cover.groupBy(key, "_a", "_z").agg(F.max(F.struct(FROM, *values)).alias("_v"))
    return held.select(key, *(F.col("_v")[c].alias(c) for c in values), F.col("_a").alias(FROM), F.col("_z").alias(TO))


def as_of_join(facts: DataFrame, intervals: DataFrame, key: str, time: str, bucket_days: int = 1) -> DataFrame:
    """``facts`` with the fields of the version that holds at ``time``; null where none does.

    ``intervals`` do not overlap (see ``disjoint``). Facts without key or time get no version.
    """
    values = [c for c in intervals.columns if c not in (key, FROM, TO)]
    day = lambda c: F.floor(F.unix_date(F.to_date(c)) / bucket_days)
    first, last = facts.agg(F.min(time), F.max(time)).first()
    if first is None:
        return facts.withColumns({c: F.lit(None).cast(intervals.schema[c].dataType) for c in values})
    lo, hi = F.lit(first), F.lit(last)
    covers = F.sequence(day(F.greatest(FROM, lo)), day(F.least(F.coalesce(TO, hi), hi)))
    held = intervals.where((F.col(FROM) <= hi) & (F.col(TO).isNull() | (F.col(TO) > lo))).withColumn("_b", F.explode(covers)).select(
        F.col(key).alias("_k"), "_b", F.col(FROM).alias("_from"), F.col(TO).alias("_to"), *(F.col(c).alias(f"_v_{c}") for c in values))
    t = F.col(time)
    on = (F.col(key) == F.col("_k")) & (F.col("_d") == F.col("_b")) & (t >= F.col("_from")) & (F.col("_to").isNull() | (t < F.col("_to")))
    out = facts.withColumn("_d", day(time)).join(held, on, "left").drop("_d", "_b", "_k", "_from", "_to")
    return out.withColumns({c: F.col(f"_v_{c}") for c in values}).drop(*(f"_v_{c}" for c in values))
