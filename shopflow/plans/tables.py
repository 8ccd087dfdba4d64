"""The KPI tables and document collections, defined once for every caller.

``facts`` is a ``Retail`` context (from the raw inputs) or ``WrittenSales``
(from the written wide table): both offer ``sales``, ``wide``, ``inventory``
and sums with game (``items``) or customer (``people``) columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopflow.operators import documents, kpis

# name -> table of the facts
KPIS = {
    "top_juegos": lambda f: kpis.top_products(f.items(scores=True)),
    "categorias": lambda f: kpis.categories(f.items()),
    "plataformas": lambda f: kpis.kpi_platforms(f.sales, f.inventory),
    "ventas_mensuales": lambda f: kpis.kpi_monthly(f.sales),
    "top_clientes": lambda f: kpis.top_customers(f.people()),
    "pago_membresia": lambda f: kpis.payment_by_segment(f.people("metodo_pago")),
    "stock_bajo": lambda f: kpis.kpi_low_stock(f.inventory),
    "resumen_ejecutivo": lambda f: kpis.kpi_summary(f.sales),
}

# The seven document collections of a run.
COLLECTIONS = {
    "ventas_procesadas": lambda f: documents.sales_documents(f.wide),
    "analisis_juegos": KPIS["top_juegos"],
    "analisis_categorias": KPIS["categorias"],
    "analisis_plataformas": KPIS["plataformas"],
    "reportes_mensuales": lambda f: documents.monthly_report(f.sales, f.items("anio", "mes")),
    "perfil_clientes": KPIS["top_clientes"],
    "alertas_inventario": lambda f: kpis.low_stock_rows(f.inventory),
}


def charts(f) -> DataFrame:
    """The chart series of the KPI report."""
    return documents.charts_of(KPIS["top_juegos"](f), KPIS["plataformas"](f), kpis.monthly_totals(f.sales),
                               KPIS["top_clientes"](f), kpis.low_stock_rows(f.inventory))
