"""Integration and KPIs on inline data."""

import datetime as dt

import pytest

from shopflow.operators import integrate, kpis, windows
from shopflow.schemas import INVENTORY


@pytest.fixture()
def wide(spark):
    rows = [
        # venta_id fecha cliente juego plat precio cant total mes anio nombre nivel categoria titulo punt
        ("V1", dt.date(2024, 1, 5), "C1", "G1", "PS5", 10.0, 2, 20.0, 1, 2024, "Ana", "Gold", "RPG", "T1", 4.0, "Yape", "Lima"),
        ("V2", dt.date(2024, 1, 9), "C2", "G2", "PS5", 5.0, 4, 20.0, 1, 2024, "Bea", "Gold", "RPG", "T2", None, "Plin", "Cusco"),
        ("V3", dt.date(2024, 2, 1), "C1", "G1", "XBOX", 10.0, 1, 10.0, 2, 2024, "Ana", "Gold", "RPG", "T1", 4.0, "Yape", "Lima"),
        ("V4", dt.date(2024, 2, 3), "C3", "G3", "PC", 2.5, 3, 7.5, 2, 2024, None, None, None, None, None, "Yape", None),
        ("V5", None, "C2", "G2", "PS5", 1.0, 1, 1.0, None, None, "Bea", "Gold", "RPG", "T2", None, "Plin", "Cusco"),
    ]
    return spark.createDataFrame(rows, "venta_id string, fecha date, cliente_id string, juego_id string, "
                                 "plataforma string, precio double, cantidad int, total double, mes int, "
                                 "anio int, nombre string, nivel_membresia string, categoria string, "
                                 "titulo string, puntuacion_promedio double, metodo_pago string, distrito string")


@pytest.fixture()
def inventory(spark):
    return spark.createDataFrame([
        ("G1", "T1", "PS5", 3, 10.0, 5), ("G2", "T2", "PS5", 7, 5.0, 5),
        ("G1", "T1", "XBOX", 5, 10.0, 5), ("G9", "T9", "SWITCH", 6, 1.0, 5)], INVENTORY)


def test_review_scores(spark):
    rv = spark.createDataFrame([("R1", " g1", 4.0, 2), ("R2", "G1", 5.0, None), (None, "G1", 3.0, 1),
                                ("R4", "G2", None, 0)], "resena_id string, juego_id string, puntuacion double, util_votos int")
    got = sorted(tuple(r) for r in integrate.review_scores(rv).collect())
    assert got == [("G1", 4.0, 2, 3), ("G2", None, 1, 0)]


def test_enrich_keeps_sale_count_and_fills(spark):
    sales = spark.createDataFrame([("V1", "C1", "G1", "PS5"), ("V2", "C9", "G1", "XBOX"), ("V3", "C1", "G2", "PS5"),
                                   ("V4", None, "G1", None)],
                                  "venta_id string, cliente_id string, juego_id string, plataforma string")
    cust = spark.createDataFrame([("C1", "Ana", 30, "F", "Lima", "Gold")], "cliente_id string, nombre string, edad int, genero string, distrito string, nivel_membresia string")
    cat = spark.createDataFrame([("G1", "PS5", "T1", "RPG", "dev", 2020, ["a"])], "juego_id string, plataforma string, titulo string, categoria string, desarrollador string, anio_lanzamiento int, tags array<string>")
    sc = spark.createDataFrame([("G1", 4.5, 2, 3)], "juego_id string, puntuacion_promedio double, total_resenas long, total_votos_util long")
    act = spark.createDataFrame([("C9", 2, 0)], "cliente_id string, compras_en_log long, sesiones_log long")
    w = {r.venta_id: r for r in integrate.enrich_sales(sales, cust, cat, sc, act).collect()}
    assert len(w) == 4
    assert w["V4"].titulo is None and w["V4"].puntuacion_promedio == 4.5 and w["V4"].nombre is None
    assert w["V1"].titulo == "T1" and w["V1"].nombre == "Ana" and w["V1"].compras_en_log is None
    assert w["V2"].titulo is None and w["V2"].puntuacion_promedio == 4.5 and w["V2"].compras_en_log == 2
    assert w["V3"].titulo is None and w["V3"].puntuacion_promedio is None


def test_top_products_tie_break(wide):
    got = [(r.juego_id, r.total_unidades) for r in kpis.kpi_top_products(wide, k=2).collect()]
    assert got == [("G2", 5), ("G1", 3)]
    got = [r.juego_id for r in kpis.kpi_top_products(wide, k=1).collect()]
    assert got == ["G2"]


def test_categories_share_excludes_unclassified(wide):
    r = kpis.kpi_categories(wide).collect()
    assert len(r) == 1 and r[0].num_ventas == 4 and r[0].pct_ventas == 100.0


def test_platforms_true_stock_and_share(wide, inventory):
    got = {r.plataforma: r for r in kpis.kpi_platforms(wide, inventory).collect()}
    assert got["PS5"].num_ventas == 3 and got["PS5"].stock_actual == 10  # not 10 x 3 sales
    assert got["XBOX"].stock_actual == 5 and got["PC"].stock_actual == 0
    assert got["PS5"].cuota_mercado_pct == 60.0 and got["PC"].cuota_mercado_pct == 20.0
    assert got["PS5"].ingresos_total == 41.0 and got["PS5"].ticket_promedio == 5.33


def test_monthly_distinct_and_null_month(wide):
    got = {(r.anio, r.mes): r for r in kpis.kpi_monthly(wide).collect()}
    assert got[(2024, 1)].clientes_unicos == 2 and got[(2024, 1)].ticket_promedio == 20.0
    assert (None, None) in got
    assert sum(r.num_transacciones for r in got.values()) == 5


def test_top_customers_and_last_date(wide):
    got = kpis.kpi_top_customers(wide).collect()
    assert [r.cliente_id for r in got] == ["C1", "C2"]
    assert got[0].ultima_compra == dt.date(2024, 2, 1) and got[0].gasto_total == 30.0


def test_payment_by_segment_and_summary(wide):
    got = [tuple(r) for r in kpis.kpi_payment_by_segment(wide).collect()]
    assert got == [("Gold", "Plin", 2), ("Gold", "Yape", 2)]
    s = kpis.kpi_summary(wide).first()
    assert (s.total_ventas, s.total_unidades_vendidas, s.ingresos_totales_soles,
            s.clientes_activos, s.juegos_vendidos) == (5, 11, 58.5, 3, 3)
    assert s.ticket_promedio == 11.7


def test_low_stock_sorted(inventory):
    got = [(r.juego_id, r.stock) for r in kpis.kpi_low_stock(inventory).collect()]
    assert got == [("G1", 3), ("G1", 5)]


def test_monthly_best_and_vs_mean(wide):
    best = {(r.anio, r.mes): r for r in windows.monthly_best(wide).collect()}
    assert best[(2024, 1)].juego_top == "T2" and best[(2024, 1)].plataforma_top == "PS5"
    assert best[(2024, 2)].juego_top == "T1" and best[(2024, 2)].plataforma_top == "PC"
    assert (None, None) not in best
    m = {(r.anio, r.mes): r for r in windows.monthly_vs_mean(wide).collect()}
    assert m[(2024, 1)].media_mensual == 28.75
    assert m[(2024, 1)].pct_vs_media == 39.1 and m[(2024, 2)].pct_vs_media == -39.1


def test_revenue_share(wide):
    got = windows.revenue_share(wide).collect()
    assert len(got) == 1 and got[0].pct_ingresos == 100.0


def test_approx_distinct_variants(wide):
    exact = {(r.anio, r.mes): r.clientes_unicos for r in kpis.kpi_monthly(wide).collect()}
    approx = {(r.anio, r.mes): r.clientes_unicos for r in kpis.kpi_monthly(wide, approx=True).collect()}
    assert exact == approx  # HyperLogLog++ is exact at these cardinalities
    a, e = kpis.kpi_summary(wide, approx=True).first(), kpis.kpi_summary(wide).first()
    assert (a.clientes_activos, a.juegos_vendidos) == (e.clientes_activos, e.juegos_vendidos)
