"""Queries over stored month summaries, each with the exact answer beside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.operators import summaries as sm
from shopflow.plans import staged
from shopflow.plans.context import Retail
from shopflow.session import work_path

RANKS = [0.05, 0.25, 0.5, 0.75, 0.95]


def stored(r: Retail, df: DataFrame) -> DataFrame:
    """``df`` written as Parquet and read again, as the summaries lie beside the KPIs."""
    return staged.kept(df, "summaries")[0]


def periods(df: DataFrame) -> DataFrame:
    """Years and the whole time of ``summaries.with_period``, and the months."""
    month = df.filter(F.col("anio").isNotNull()).withColumn("periodo", F.format_string("%d-%02d", "anio", "mes"))
    return sm.with_period(df).unionByName(month)


def months_of(df: DataFrame, **keys: str) -> DataFrame:
    """One row per key and year, with its months as bits: (columna, clave, anio, meses). ``keys``: column -> columna."""
    one = df.select("anio", "mes", F.explode(F.array(*[
        F.struct(F.lit(name).alias("columna"), F.col(c).alias("clave")) for c, name in keys.items()])).alias("x")).select("anio", "mes", "x.*")
    return one.groupBy("columna", "clave", "anio").agg(F.bit_or(F.expr("shiftleft(1, coalesce(mes, 0))")).alias("meses"))


def distinct_keys(months: DataFrame, *names: str) -> DataFrame:
    """Distinct keys of every period of ``months_of`` rows, NULL left out, a column per name."""
    dated = months.filter(F.col("anio").isNotNull())
    bits = dated.withColumn("mes", F.explode(F.filter(F.sequence(F.lit(1), F.lit(12)), lambda m: F.getbit("meses", m) == 1)))
    spans = (months.select("columna", "clave").distinct().withColumn("periodo", F.lit("todo"))
             .unionByName(dated.select("columna", "clave", F.col("anio").cast("string").alias("periodo")))
             .unionByName(bits.select("columna", "clave", F.format_string("%d-%02d", "anio", "mes").alias("periodo"))))
    return spans.groupBy("periodo").agg(*[F.count(F.when(F.col("columna") == n, F.col("clave"))).alias(n) for n in names])


def near(found: Column, exact: Column) -> Column:
    return F.abs(found - exact) <= F.ceil(exact * sm.DISTINCT_ERROR)


def distinct_by_period(r: Retail) -> DataFrame:
    """Distinct customers and games of every month, year and the whole time: merged sketches within their bound of the exact counts."""
    path = work_path(r.spark, "sales")
    staged.write_sales(r, path, "anio", "mes", "cliente_id", "juego_id", "precio", "cantidad")
    sales = r.spark.read.parquet(path)
    found = sm.merged(periods(stored(r, sm.month_summaries(sales))), "periodo").select(
        "periodo", sm.distinct("clientes").alias("c"), sm.distinct("juegos").alias("j"))
    keys = stored(r, months_of(sales, cliente_id="clientes", juego_id="juegos"))
    exact = distinct_keys(keys, "clientes", "juegos")
    return exact.join(found, "periodo", "left").select(
        "periodo", "clientes", "juegos", near(F.col("c"), F.col("clientes")).alias("clientes_en_cota"), near(F.col("j"), F.col("juegos")).alias("juegos_en_cota"))


def quantiles_by_period(r: Retail) -> DataFrame:
    """Q1, Q2: quantiles of price and quantity of every month, year and the whole time from merged sketches, their ranks within the bound."""
    merged = sm.merged(periods(stored(r, sm.month_summaries(r.sales))), "periodo")
    found = stored(r, merged.select("periodo", F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.lit(p).alias("rango"), sm.quantile(c, p).alias("valor"))
        for c in ("precio", "cantidad") for p in RANKS])).alias("q")).select("periodo", "q.*"))
    values = periods(r.sales.select("anio", "mes", F.explode(F.array(
        F.struct(F.lit("precio").alias("columna"), F.col("precio").alias("v")),
        F.struct(F.lit("cantidad").alias("columna"), F.col("cantidad").cast("double").alias("v")))).alias("x")).select("anio", "mes", "x.*"))
    values = values.filter(F.col("v").isNotNull()).groupBy("periodo", "columna", "v").agg(F.count(F.lit(1)).alias("n"))
    met = values.join(found, ["periodo", "columna"]).groupBy("periodo", "columna", "rango").agg(
        F.sum("n").alias("filas"), F.sum(F.when(F.col("v") < F.col("valor"), F.col("n")).otherwise(0)).alias("menores"),
        F.sum(F.when(F.col("v") <= F.col("valor"), F.col("n")).otherwise(0)).alias("hasta"))
    # a value's ranks reach from the share below it to the share up to it
    slack = sm.RANK_ERROR * F.col("filas") + 1
    inside = (F.col("menores") - slack <= F.col("rango") * F.col("filas")) & (F.col("rango") * F.col("filas") <= F.col("hasta") + slack)
    return met.select("periodo", "columna", "rango", "filas", inside.alias("en_cota"))


def sales_drift(r: Retail) -> DataFrame:
    """Q2: whether price or quantity moved against the sales until 1999: in those from 2000 on, and in the same at one and a half times the price."""
    parts = {"antes": r.sales.filter("anio < 2000"), "desde_2000": r.sales.filter("anio >= 2000"),
             "encarecido": r.sales.filter("anio >= 2000").withColumn("precio", F.col("precio") * 1.5)}
    kept = None
    for name, df in parts.items():
        one = sm.month_summaries(df.withColumn("entrega", F.lit(name)), "entrega")
        kept = one if kept is None else kept.unionByName(one)
    kept = stored(r, kept)
    out = [sm.drift(kept.filter("entrega = 'antes'"), kept.filter(F.col("entrega") == n)).select(F.lit(n).alias("entrega"), "columna", "deriva")
           for n in ("desde_2000", "encarecido")]
    return out[0].unionByName(out[1])


def top_games_by_period(r: Retail) -> DataFrame:
    """The ten best-selling games of every year and the whole time from month summaries, exact."""
    return sm.top_games(stored(r, sm.game_summaries(r.sales)), r.sales).select("periodo", F.col("puesto").cast("long").alias("puesto"), "juego_id", "unidades")


QUERIES = {f.__name__: f for f in (distinct_by_period, quantiles_by_period, sales_drift, top_games_by_period)}
