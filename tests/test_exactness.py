"""Rounding after the arithmetic, and no silent loss of sales or settings."""

import pytest
from pyspark.sql import functions as F

from shopflow import session
from shopflow.functions import columns as C
from shopflow.operators import cleanse, integrate, kpis
from shopflow.sinks import files as sinks
from shopflow.streaming import events as st

SALES = "venta_id string, fecha string, cliente_id string, juego_id string, plataforma string, precio double, cantidad int, metodo_pago string, vendedor string"


def sales(spark, rows):
    return spark.createDataFrame([(i, "2024-01-02", "C1", "G1", "PS5", p, q, "Yape", "S1") for i, p, q in rows], SALES)


def test_products_and_averages_are_rounded_once(spark):
    got = {r.venta_id: r.total for r in cleanse.clean_sales(sales(spark, [("a", 1.005, 2), ("b", 0.333, 3), ("c", 19.99, 3)])).collect()}
    assert got == {"a": 2.01, "b": 1.0, "c": 59.97}
    scores = spark.createDataFrame([("r1", "G1", 4.005, 1), ("r2", "G1", 4.004, 1)], "resena_id string, juego_id string, puntuacion double, util_votos int")
    assert integrate.review_scores(scores).first().puntuacion_promedio == 4.0
    risks = spark.createDataFrame([("Yape", 1.0, 0.745), ("Yape", 1.0, 0.744)], "metodo_pago string, total double, riesgo_fraude double")
    assert st.stream_by_payment(risks).first().riesgo_promedio == 0.74


def test_bad_prices_and_ids_are_rejected_not_lost(spark):
    rows = [("a", 10.0, 1), (None, 10.0, 1), (None, 11.0, 1), ("b", 1e17, 5), ("c", float("nan"), 1), ("d", 0.0, 1), ("e", None, 1), ("f", float("inf"), 1), ("g", 5.0, None)]
    raw = sales(spark, rows)
    assert sorted(r.venta_id for r in cleanse.clean_sales(raw).collect()) == ["a", "g"]
    got = sorted((r.motivo, r.venta_id or "") for r in cleanse.rejected_sales(raw).collect())
    assert got == [("precio fuera de rango", "b"), ("precio fuera de rango", "c"), ("precio fuera de rango", "f"), ("venta_id nulo", ""), ("venta_id nulo", "")]
    assert kpis.kpi_summary(cleanse.clean_sales(raw)).first().ingresos_totales_soles == 10.0


def test_plain_numbers_at_any_size(spark):
    values = [18667993.8, 1e15, 123456789012345680.0, 1.5e25, 0.1, 1e-12, 12345.678901234567, -2.5, 0.0, 100.0]
    got = [r.x for r in sinks.plain_numbers(spark.createDataFrame([(v,) for v in values], "x double")).collect()]
    assert [float(g) for g in got] == values and not any("E" in g for g in got)
    assert got[-1] == "100" and got[1] == "1000000000000000"


def test_no_private_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *a):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_kpis_from_sums_equal_kpis_from_sales(spark):
    """A hot customer and game reach the dimension as one row per task."""
    raw = spark.range(4000).select(
        F.concat(F.lit("V"), F.col("id").cast("string")).alias("venta_id"), F.lit("2024-01-02").alias("fecha"),
        F.when(F.col("id") % 2 == 0, "C0").otherwise(F.concat(F.lit("C"), (F.col("id") % 37).cast("string"))).alias("cliente_id"),
        F.lit("G0").alias("juego_id"), F.lit("PS5").alias("plataforma"), (F.col("id") % 9 + 0.125).alias("precio"),
        F.lit(2).alias("cantidad"), F.lit("Yape").alias("metodo_pago"), F.lit("S").alias("vendedor")).repartition(4)
    clean = cleanse.clean_sales(raw)
    people = spark.range(37).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("cliente_id"), F.lit("n").alias("nombre"), F.lit(1).alias("edad"),
                                    F.lit("F").alias("genero"), F.lit("d").alias("distrito"), F.lit("Gold").alias("nivel_membresia"))
    summed = kpis.top_customers(integrate.enrich_sales(kpis.sold(clean, "cliente_id"), customers=people))
    whole = kpis.kpi_top_customers(integrate.enrich_sales(clean, customers=people))
    assert summed.collect() == whole.collect()
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Join") < plan.rindex("partial_sum")  # the sums stand below the join


def test_ratio(spark):
    r = spark.range(1).select(C.ratio(F.lit(1).cast("decimal(10,2)"), F.lit(8)).alias("a"), C.ratio(F.lit(1).cast("decimal(10,2)"), F.lit(0)).alias("b")).first()
    assert (r.a, r.b) == (0.13, None)
