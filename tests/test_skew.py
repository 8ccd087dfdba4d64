"""A third of all rows on one key: results stay exact and whole, and every
grouping step aggregates partially before its shuffle."""

import pandas as pd
from pyspark.sql import functions as F

from shopflow.operators import cleanse, kpis, logs, windows

N = 30_000


def skewed_sales(spark):
    # every third sale belongs to customer C0, game G0 and month 2024-01
    ids = spark.range(N).withColumn("hot", (F.col("id") % 3) == 0)
    return ids.select(
        F.concat(F.lit("V"), (F.col("id") % 20_000).cast("string")).alias("venta_id"),  # duplicates too
        F.when(F.col("hot"), F.lit("2024-01-15")).otherwise(
            F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 700).cast("int")),
                          "yyyy-MM-dd")).alias("fecha"),
        F.when(F.col("hot"), F.lit("C0")).otherwise(F.concat(F.lit("C"), (F.col("id") % 997).cast("string"))).alias("cliente_id"),
        F.when(F.col("hot"), F.lit("G0")).otherwise(F.concat(F.lit("G"), (F.col("id") % 101).cast("string"))).alias("juego_id"),
        F.when(F.col("hot"), F.lit("PS5")).otherwise(F.lit("pc")).alias("plataforma"),
        (F.lit(1.0) + (F.col("id") % 50) / 4).alias("precio"),
        (F.lit(1) + (F.col("id") % 4)).cast("int").alias("cantidad"),
        F.lit("Yape").alias("metodo_pago"),
        F.lit("S1").alias("vendedor"),
    )


def test_dedupe_and_kpis_under_skew(spark):
    raw = skewed_sales(spark).repartition(8)
    sales = cleanse.clean_sales(raw)
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan  # map-side reduction before the shuffle

    pdf = raw.toPandas()  # small fixture: brute force in pandas
    pdf["fecha_d"] = pd.to_datetime(pdf["fecha"]).dt.date
    pdf["total"] = (pdf["precio"] * 100).round().astype("int64") * pdf["cantidad"]
    pdf = pdf.sort_values(["venta_id", "fecha", "cliente_id", "juego_id"], ascending=False)
    best = pdf.drop_duplicates("venta_id")
    got = sales.count()
    assert got == len(best) == 20_000

    s = kpis.kpi_summary(sales).first()
    assert s.total_ventas == 20_000
    assert s.clientes_activos == best["cliente_id"].nunique()
    assert round(s.ingresos_totales_soles * 100) == int(best["total"].sum())

    m = {(r.anio, r.mes): r.num_transacciones for r in kpis.kpi_monthly(sales).collect()}
    want = best.assign(a=[d.year for d in best["fecha_d"]], m=[d.month for d in best["fecha_d"]]).groupby(["a", "m"]).size()
    assert m == {k: int(v) for k, v in want.items()}

    top = windows.monthly_best(sales.withColumn("titulo", F.col("juego_id")).withColumn("categoria", F.lit("X")))
    jan = {(r.anio, r.mes): r.juego_top for r in top.collect()}[(2024, 1)]
    assert jan == "G0"
    mplan = top._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in mplan and "partial_min" in mplan


def test_log_counts_under_skew(spark):
    lines = spark.range(N).select(F.when((F.col("id") % 3) == 0, F.lit("2024-01-01 00:00:00 INFO C0 PURCHASE G1"))
                                  .otherwise(F.concat(F.lit("2024-01-01 00:00:00 INFO C"),
                                                      (F.col("id") % 50).cast("string"), F.lit(" LOGIN")))
                                  .alias("value")).repartition(8)
    got = {r.cliente_id: (r.compras_en_log, r.sesiones_log) for r in logs.log_activity(lines).collect()}
    assert got["C0"][0] == N // 3
    assert sum(v[1] for v in got.values()) == N - N // 3
    plan = logs.log_activity(lines)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_salted_enrichment_equals_plain(spark):
    from shopflow.operators import integrate

    sales = cleanse.clean_sales(skewed_sales(spark).repartition(8))
    cust = spark.range(997).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("cliente_id"),
                                   F.lit("n").alias("nombre"), F.lit(30).alias("edad"), F.lit("F").alias("genero"),
                                   F.lit("d").alias("distrito"), F.lit("Gold").alias("nivel_membresia"))
    cat = spark.createDataFrame([("G0", "PS5", "T0", "RPG", "dev", 2020, ["a"]), ("G1", "PC", "T1", "RPG", "dev", 2021, [])],
                                "juego_id string, plataforma string, titulo string, categoria string, "
                                "desarrollador string, anio_lanzamiento int, tags array<string>")
    sc = spark.createDataFrame([("G0", 4.5, 2, 3)], "juego_id string, puntuacion_promedio double, total_resenas long, total_votos_util long")
    act = spark.createDataFrame([("C0", 5, 1)], "cliente_id string, compras_en_log long, sesiones_log long")
    plain = integrate.enrich_sales(sales, cust, cat, sc, act)
    salted = integrate.enrich_sales(sales, cust, cat, sc, act, salt=6)
    cols = [c for c in plain.columns if c != "tags"]
    assert sorted(tuple(r) for r in plain.select(cols).collect()) == sorted(tuple(r) for r in salted.select(cols).collect())
    p = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in p
