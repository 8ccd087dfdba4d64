"""Mergeable summaries of the wide sales table, one row per month, kept beside the KPIs.

A summary of any range of months comes from the stored rows alone: distinct customers
and games (HyperLogLog sketches), quantiles of price and quantity (KLL sketches), and
the best-selling games (largest sums per month with a bound for all others).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONTH = ["anio", "mes"]
#: log2 of the registers of a distinct-count sketch (16 KB), and the bound of its relative error: three standard errors of 1.04 / sqrt(registers).
REGISTERS = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (REGISTERS / 2)
#: Accuracy parameter of a quantile sketch, and the rank error taken as its bound: 0.33 % at 99 % confidence for this parameter, tripled.
KLL_K = 800
RANK_ERROR = 0.01
#: Ranks at which two distributions are compared, and the difference of cumulative shares that counts as drift.
POINTS = [i / 100 for i in range(1, 100)]
DRIFT = 0.1
#: Games kept per month.
KEPT = 1000


def month_summaries(wide: DataFrame, *by: str) -> DataFrame:
    """One row per month (or per ``by``): sketches of customers, games, prices and quantities. One shuffle of partial sketches."""
    return wide.groupBy(*(by or MONTH)).agg(
        F.hll_sketch_agg("cliente_id", REGISTERS).alias("clientes"), F.hll_sketch_agg("juego_id", REGISTERS).alias("juegos"),
        F.kll_sketch_agg_double("precio", KLL_K).alias("precio"), F.kll_sketch_agg_double(F.col("cantidad").cast("double"), KLL_K).alias("cantidad"))


def merged(summaries: DataFrame, *by: str) -> DataFrame:
    """The summaries of all rows of a group as one; without ``by``, of all rows."""
    return summaries.groupBy(*by).agg(
        F.hll_union_agg("clientes").alias("clientes"), F.hll_union_agg("juegos").alias("juegos"),
        F.kll_merge_agg_double("precio", KLL_K).alias("precio"), F.kll_merge_agg_double("cantidad", KLL_K).alias("cantidad"))


def distinct(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile(sketch: str, rank: float) -> Column:
    """The value at ``rank`` (0 to 1), within ``RANK_ERROR``; NULL of no values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))


def distance(a: str, b: str) -> Column:
    """Greatest difference of the two sketches' cumulative shares, taken at the quantiles of either: the
    Kolmogorov-Smirnov distance within one step of ``POINTS`` and the two rank errors. NULL if either has no values."""
    ranks = F.array(*[F.lit(p) for p in POINTS])
    qa, qb = (F.kll_sketch_get_quantile_double(s, ranks) for s in (a, b))

    def below(values: Column, v: Column) -> Column:
        return F.size(F.filter(values, lambda x: x <= v))
    found = F.array_max(F.transform(F.concat(qa, qb), lambda v: F.abs(below(qa, v) - below(qb, v)))) / (len(POINTS) + 1)
    return F.when((F.kll_sketch_get_n_double(a) > 0) & (F.kll_sketch_get_n_double(b) > 0), found)


def drift(before: DataFrame, after: DataFrame, columns: tuple[str, ...] = ("precio", "cantidad")) -> DataFrame:
    """Whether a column's distribution moved between two one-row summaries: columna, distancia, deriva."""
    sides = before.select(*columns, F.lit("a").alias("_side")).unionByName(after.select(*columns, F.lit("b").alias("_side")))
    both = sides.agg(*[F.max(F.when(F.col("_side") == side, F.col(c))).alias(f"{side}_{c}") for c in columns for side in "ab"])
    found = both.select(F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), distance(f"a_{c}", f"b_{c}").alias("distancia")) for c in columns])).alias("d"))
    return found.select("d.columna", "d.distancia", F.coalesce(F.col("d.distancia") > DRIFT, F.lit(False)).alias("deriva"))


def game_summaries(wide: DataFrame, kept: int = KEPT) -> DataFrame:
    """Per month the ``kept`` best-selling games and their units; the row after them, of the best game left
    out, bounds every other game of the month. Units must not be negative."""
    sums = wide.filter(F.col("juego_id").isNotNull()).groupBy(*MONTH, "juego_id").agg(F.sum("cantidad").alias("unidades")).filter("unidades > 0")
    place = F.row_number().over(Window.partitionBy(*MONTH).orderBy(F.desc("unidades"), "juego_id"))
    return sums.withColumn("puesto", place).filter(F.col("puesto") <= kept + 1)


def with_period(df: DataFrame) -> DataFrame:
    """Each row once per period that holds it: its year and the whole time; rows without a date only the latter."""
    periods = F.array_compact(F.array(F.lit("todo"), F.col("anio").cast("string")))
    return df.withColumn("periodo", F.explode(periods))


def top_games(summaries: DataFrame, facts: DataFrame, k: int = 10, kept: int = KEPT) -> DataFrame:
    """The exact ``k`` best-selling games of each period, from month summaries.

    A game's units lie between the sum of its stored rows and that sum plus the bounds of
    the months that do not store it. Only games whose upper end reaches the k-th lower end
    can be among the best; those that some month does not store are summed from the facts,
    and nothing else is read. Where a game that no month stores could reach it too
    (the bounds' sum is as high), the period is summed whole: such a period has no
    game that stands out. So the result is exact in every case."""
    s = with_period(summaries)
    rest = summaries.filter(F.col("puesto") == kept + 1).select(*MONTH, F.col("unidades").alias("tope"))
    total = with_period(rest).groupBy("periodo").agg(F.sum("tope").alias("topes"))
    match = [F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}")) for c in MONTH]
    stored = s.filter(F.col("puesto") <= kept).alias("s").join(rest.alias("r"), match, "left").select("s.periodo", "s.juego_id", "s.unidades", "r.tope")
    held = (stored.groupBy("periodo", "juego_id").agg(F.sum("unidades").alias("menos"), F.coalesce(F.sum("tope"), F.lit(0)).alias("visto"))
            .join(total, "periodo", "left").withColumn("topes", F.coalesce("topes", F.lit(0))))
    held = held.withColumn("mas", F.col("menos") + F.col("topes") - F.col("visto"))
    order = Window.partitionBy("periodo").orderBy(F.desc("menos"), "juego_id")
    lowest = held.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).groupBy("periodo").agg(
        F.count(F.lit(1)).alias("hay"), F.min("menos").alias("umbral"), F.max("topes").alias("topes"))
    # with fewer than k stored games every game counts; with nothing left out none is unknown
    lowest = lowest.withColumn("umbral", F.when(F.col("hay") == k, F.col("umbral")).otherwise(F.lit(0)))
    lowest = lowest.select("periodo", "umbral", ((F.col("topes") > 0) & (F.col("topes") >= F.col("umbral"))).alias("abierto"))
    able = held.join(lowest, "periodo").filter(~F.col("abierto") & (F.col("mas") >= F.col("umbral")))
    known = able.filter(F.col("mas") == F.col("menos")).select("periodo", "juego_id", F.col("menos").alias("unidades"))
    unknown = able.filter(F.col("mas") > F.col("menos")).select("periodo", "juego_id")
    sales = with_period(facts.select(*MONTH, "juego_id", "cantidad").filter(F.col("juego_id").isNotNull()))
    read = sales.join(unknown, ["periodo", "juego_id"], "left_semi").unionByName(
        sales.join(lowest.filter("abierto").select("periodo"), "periodo", "left_semi").select("periodo", "juego_id", *MONTH, "cantidad"))
    counted = read.groupBy("periodo", "juego_id").agg(F.sum("cantidad").alias("unidades")).filter("unidades > 0")
    best = Window.partitionBy("periodo").orderBy(F.desc("unidades"), "juego_id")
    return known.unionByName(counted).withColumn("puesto", F.row_number().over(best)).filter(F.col("puesto") <= k)
