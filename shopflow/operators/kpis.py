"""The eight business KPIs over the wide sales table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.functions.columns import exact, exact_avg, money, money_avg, money_sum, pct_of, ratio
from shopflow.functions.predicates import low_stock, present


def with_share(agg: DataFrame, measure: str, out: str, digits: int = 1) -> DataFrame:
    """Measure as a percentage of its total over all rows.

    The total is taken over the groups of the same aggregate, so the facts are
    read once. ``agg`` has one row per category or platform: a bounded domain.
    """
    total = F.sum(F.col(measure).cast("decimal(22,2)")).over(Window.partitionBy())
    return agg.withColumn(out, pct_of(F.col(measure), total, digits))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """O1: top k by a total order (the caller ends ``order`` with a unique
    key as tie-break).  Planned as TakeOrderedAndProject: each partition
    keeps its own k best, only those reach the final merge."""
    return df.orderBy(*order).limit(k)


def sold(sales: DataFrame, *keys: str) -> DataFrame:
    """Sales summed by ``keys`` before they meet a dimension: a hot customer,
    game or month reaches the join as one row.  Sums and counts are kept, so
    they can be summed again and averages are taken at the end; sums that a
    query does not read are pruned."""
    return sales.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_filas"), F.count("venta_id").alias("_ventas"), F.sum("cantidad").alias("_unidades"),
        F.sum(money("total")).alias("_ingresos"), F.count("total").alias("_totales"),
        F.sum(exact("precio")).alias("_precios"), F.count("precio").alias("_con_precio"), F.max("fecha").alias("_ultima"))


def each_sale(sales: DataFrame, *keys: str) -> DataFrame:
    """The columns of ``sold`` for every single sale: where no dimension is joined, the KPI's own group-by is the only one."""
    return sales.select(
        *keys, F.lit(1).cast("long").alias("_filas"), F.col("venta_id").isNotNull().cast("long").alias("_ventas"),
        F.col("cantidad").cast("long").alias("_unidades"), money("total").alias("_ingresos"), F.col("total").isNotNull().cast("long").alias("_totales"),
        exact("precio").alias("_precios"), F.col("precio").isNotNull().cast("long").alias("_con_precio"), F.col("fecha").alias("_ultima"))


def revenue() -> Column:
    return F.round(F.sum("_ingresos"), 2).cast("double")


def top_products(items: DataFrame, k: int = 10) -> DataFrame:
    """KPI1 (A4) from ``sold`` rows with game columns: best-selling games by units."""
    agg = (items.filter(present("titulo"))
                .groupBy("juego_id", "titulo", "categoria")
                .agg(F.sum("_unidades").alias("total_unidades"),
                     F.sum("_ventas").alias("num_transacciones"),
                     revenue().alias("ingresos_total"),
                     # a game's score is the same in each of its rows
                     F.round(F.max(exact("puntuacion_promedio")), 2).cast("double").alias("rating_promedio")))
    return top_k(agg, [F.desc("total_unidades"), F.asc("juego_id")], k)


def categories(items: DataFrame) -> DataFrame:
    """KPI2 (A5) from ``sold`` rows with game columns: per category; share of the classified sales."""
    agg = (items.filter(present("categoria")).groupBy("categoria")
                .agg(F.sum("_ventas").alias("num_ventas"), F.sum("_unidades").alias("total_unidades"),
                     revenue().alias("ingresos_total"),
                     ratio(F.sum("_precios"), F.sum("_con_precio")).alias("precio_promedio")))
    return with_share(agg, "num_ventas", "pct_ventas").orderBy(F.desc("ingresos_total"), "categoria")


def top_customers(people: DataFrame, k: int = 10) -> DataFrame:
    """KPI5 (A8) from ``sold`` rows with customer columns: customers by spend, with their last purchase date."""
    agg = (people.filter(present("nombre"))
                 .groupBy("cliente_id", "nombre", "nivel_membresia", "distrito")
                 .agg(F.sum("_ventas").alias("num_compras"), revenue().alias("gasto_total"),
                      ratio(F.sum("_ingresos"), F.sum("_totales")).alias("ticket_promedio"),
                      F.max("_ultima").alias("ultima_compra")))
    return top_k(agg, [F.desc("gasto_total"), F.asc("cliente_id")], k)


def payment_by_segment(people: DataFrame) -> DataFrame:
    """KPI6 (A9) from ``sold`` rows with customer columns: payment method frequency per membership level."""
    return (people.filter(present("nivel_membresia"))
                  .groupBy("nivel_membresia", "metodo_pago")
                  .agg(F.sum("_filas").alias("frecuencia"))
                  .orderBy("nivel_membresia", F.desc("frecuencia"), "metodo_pago"))


GAME_KEYS = ("juego_id", "plataforma", "titulo", "categoria", "puntuacion_promedio")
CUSTOMER_KEYS = ("cliente_id", "nombre", "nivel_membresia", "distrito")


def kpi_top_products(wide: DataFrame, k: int = 10) -> DataFrame:
    """KPI1 over the wide sales table."""
    return top_products(each_sale(wide, *GAME_KEYS), k)


def kpi_categories(wide: DataFrame) -> DataFrame:
    """KPI2 over the wide sales table."""
    return categories(each_sale(wide, "categoria"))


def stock_by_platform(inventory: DataFrame) -> DataFrame:
    """Stock summed per (canonical) platform."""
    return inventory.groupBy("plataforma").agg(F.sum("stock").alias("stock"))


def kpi_platforms(wide: DataFrame, inventory: DataFrame) -> DataFrame:
    """KPI3 (A6, J6): per platform, with market share and the true stock.

    Both sides are aggregated before the join, so stock is counted once per
    platform, not once per sale."""
    agg = (wide.groupBy("plataforma")
               .agg(F.count("venta_id").alias("num_ventas"), F.sum("cantidad").alias("total_unidades"),
                    money_sum("total").alias("ingresos_total"),
                    exact_avg("precio").alias("ticket_promedio")))
    agg = with_share(agg, "num_ventas", "cuota_mercado_pct")
    stock = stock_by_platform(inventory)
    out = agg.join(stock, "plataforma", "left").withColumn(
        "stock_actual", F.coalesce(F.col("stock"), F.lit(0)).cast("long")).drop("stock")
    return out.orderBy(F.desc("ingresos_total"), "plataforma")


def monthly_totals(wide: DataFrame, approx: bool = False) -> DataFrame:
    """KPI4's rows, unordered (for reuse inside other plans)."""
    distinct = (F.approx_count_distinct("cliente_id") if approx
                else F.count_distinct("cliente_id"))
    return (wide.groupBy("anio", "mes")
                .agg(F.count("venta_id").alias("num_transacciones"),
                     F.sum("cantidad").alias("total_unidades"),
                     money_sum("total").alias("ingresos_mes"),
                     money_avg("total").alias("ticket_promedio"),
                     distinct.alias("clientes_unicos")))


def kpi_monthly(wide: DataFrame, approx: bool = False) -> DataFrame:
    """KPI4 (A7): per year and month, with distinct customers."""
    return monthly_totals(wide, approx).orderBy("anio", "mes")


def kpi_top_customers(wide: DataFrame, k: int = 10) -> DataFrame:
    """KPI5 over the wide sales table."""
    return top_customers(each_sale(wide, *CUSTOMER_KEYS), k)


def kpi_payment_by_segment(wide: DataFrame) -> DataFrame:
    """KPI6 over the wide sales table."""
    return payment_by_segment(each_sale(wide, "nivel_membresia", "metodo_pago"))


def low_stock_rows(inventory: DataFrame) -> DataFrame:
    """KPI7's rows, unordered: this list grows with the inventory, so
    consumers that do not need the order (documents, charts) skip the
    global sort and its range shuffle."""
    return (inventory.filter(low_stock())
                     .select("juego_id", F.col("titulo_inv").alias("titulo"), "plataforma",
                             "stock", "umbral", F.col("precio_inv").alias("precio")))


def kpi_low_stock(inventory: DataFrame) -> DataFrame:
    """KPI7 (A10): stock at or below the reorder threshold, lowest first."""
    return low_stock_rows(inventory).orderBy("stock", "juego_id", "plataforma")


def kpi_summary(wide: DataFrame, approx: bool = False) -> DataFrame:
    """KPI8 (A11): one-row executive summary."""
    cd = F.approx_count_distinct if approx else F.count_distinct
    return wide.agg(F.count("venta_id").alias("total_ventas"),
                    F.sum("cantidad").alias("total_unidades_vendidas"),
                    money_sum("total").alias("ingresos_totales_soles"),
                    money_avg("total").alias("ticket_promedio"),
                    cd("cliente_id").alias("clientes_activos"),
                    cd("juego_id").alias("juegos_vendidos"))
