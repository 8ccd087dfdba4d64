"""Connected components of a link table by alternating large-star and small-star steps.

Each step groups by one end of a link with a partial minimum and joins it
back, so a vertex with very many links is never collected; every round is
written to the shared folder, which cuts the lineage. Rounds go on until the
links no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import cut


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (u > v). large: link each larger neighbour to the least one; small: each smaller or equal one."""
    sides = links.select("u", "v")
    if large:
        sides = sides.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    near = sides.join(least, "u")
    if large:
        out = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of ``links`` (a, b); the component is its least vertex.

    Self-links and nulls are left out; an empty table gives an empty one.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = cut(links, "links"), None
    while True:
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
        if not before[0]:
            break
        links = cut(_star(_star(links, True), False), "links")
    roots = links.select(F.col("v").alias("vertex")).distinct()
    return links.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(roots.select("vertex", F.col("vertex").alias("component")))
