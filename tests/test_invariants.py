"""Invariants of the KPI outputs (sums, uniqueness, bounds), at sf0.01."""

import pytest
from pyspark.sql import functions as F

from shopflow.operators import kpis
from shopflow.plans.context import Retail

from .conftest import SF01


@pytest.fixture(scope="module")
def r(spark):
    return Retail(spark, SF01)


@pytest.fixture(scope="module")
def total(r):
    return r.wide.agg(F.count("*").alias("n"), F.sum(F.col("total").cast("decimal(18,2)")).alias("rev")).first()


def test_left_joins_keep_sale_count(r):
    assert r.wide.count() == r.sales.count()


def test_platform_sums_equal_totals(r, total):
    p = kpis.kpi_platforms(r.wide, r.inventory).agg(
        F.sum("num_ventas").alias("n"), F.sum(F.col("ingresos_total").cast("decimal(18,2)")).alias("rev")).first()
    assert p.n == total.n and p.rev == total.rev


def test_monthly_and_payment_sums(r, total):
    assert kpis.kpi_monthly(r.wide).agg(F.sum("num_transacciones")).first()[0] == total.n
    no_level = r.wide.filter(F.col("nivel_membresia").isNull()).count()
    assert kpis.kpi_payment_by_segment(r.wide).agg(F.sum("frecuencia")).first()[0] + no_level == total.n


def test_categories_plus_unclassified(r, total):
    unclassified = r.wide.filter(F.col("categoria").isNull()).count()
    assert kpis.kpi_categories(r.wide).agg(F.sum("num_ventas")).first()[0] + unclassified == total.n


def test_low_stock_rows(r):
    low = kpis.kpi_low_stock(r.inventory)
    assert low.filter(F.col("stock") > F.col("umbral")).count() == 0
    assert low.count() == low.select("juego_id", "plataforma").distinct().count()


def test_stock_counted_once_per_platform(r):
    got = {x.plataforma: x.stock_actual for x in kpis.kpi_platforms(r.wide, r.inventory).collect()}
    want = {x.plataforma: x.s for x in r.inventory.groupBy("plataforma").agg(F.sum("stock").alias("s")).collect()}
    assert all(got[p] == want.get(p, 0) for p in got)


def test_summary_matches_parts(r, total):
    s = kpis.kpi_summary(r.wide).first()
    assert s.total_ventas == total.n
    assert s.clientes_activos == r.wide.select("cliente_id").distinct().count()
