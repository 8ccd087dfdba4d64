"""Nested documents, read-back and chart series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.functions.columns import money_label, money_sum, month_name
from shopflow.functions.predicates import present
from shopflow.operators import kpis, windows

# Fixed output contract: the fields of a sales document, in order.
SALES_DOC_COLUMNS = [
    "venta_id", "fecha", "mes", "anio", "trimestre",
    "cliente_id", "nombre", "edad", "genero", "distrito", "nivel_membresia",
    "juego_id", "titulo", "categoria", "plataforma",
    "precio", "cantidad", "total", "metodo_pago", "vendedor",
    "puntuacion_promedio", "total_resenas",
]


def _no_decimals(t: T.DataType) -> T.DataType:
    if isinstance(t, T.DecimalType):
        return T.DoubleType()
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _no_decimals(f.dataType), f.nullable)
                             for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_no_decimals(t.elementType), t.containsNull)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, _no_decimals(t.valueType), t.valueContainsNull)
    return t


def to_document_types(df: DataFrame) -> DataFrame:
    """Dates as ISO strings, decimals as doubles -- over the whole
    schema, inside structs and arrays too, with one cast per column."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        else:
            target = _no_decimals(f.dataType)
            if target != f.dataType:
                c = c.cast(target)
        out.append(c.alias(f.name))
    return df.select(*out)


def sales_documents(wide: DataFrame) -> DataFrame:
    """One document per sale, 22 fields, date as text."""
    return to_document_types(wide.select(*SALES_DOC_COLUMNS))


def product_profile(games: DataFrame, wide: DataFrame, scores: DataFrame) -> DataFrame:
    """Catalogue document per game with nested ``metricas``."""
    sold = wide.groupBy("juego_id").agg(F.sum("cantidad").alias("u"), money_sum("total").alias("r"))
    df = (games.join(sold, "juego_id", "left")
               .join(scores.select("juego_id", "puntuacion_promedio", "total_resenas"),
                     "juego_id", "left"))
    metricas = F.struct(
        F.coalesce(F.col("u"), F.lit(0)).cast("long").alias("total_ventas_unidades"),
        F.coalesce(F.col("r"), F.lit(0.0)).alias("ingresos_acumulados"),
        F.col("puntuacion_promedio").alias("puntuacion_promedio"),
        F.coalesce(F.col("total_resenas"), F.lit(0)).cast("long").alias("total_resenas"),
    )
    return to_document_types(df.select(*games.columns, metricas.alias("metricas")))


def monthly_report(sales: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """D3: KPI4 per month plus month name, best game / category / platform
    and the distance from the mean month as a sentence.  ``items`` are the
    month's ``sold`` rows with game columns (default: ``sales`` has them)."""
    base = windows.vs_mean(kpis.monthly_totals(sales.filter(present("anio", "mes"))))
    best = windows.monthly_best(sales if items is None else items)
    pct = F.col("pct_vs_media")
    obs = F.concat(F.format_string("%.1f", F.abs(pct)), F.lit("% "),
                   F.when(pct >= 0, F.lit("por encima")).otherwise(F.lit("por debajo")),
                   F.lit(" de la media mensual"))
    return (base.join(best, ["anio", "mes"], "left")
                .select("anio", "mes", month_name("mes").alias("nombre_mes"),
                        "num_transacciones", "total_unidades", "ingresos_mes",
                        "ticket_promedio", "clientes_unicos", "juego_top",
                        "categoria_top", "plataforma_top", obs.alias("observacion")))


# Fixed schemas of the KPI collections' documents.
COLLECTION_SCHEMAS = {
    "analisis_juegos": "juego_id string, titulo string, categoria string, total_unidades long, "
                       "num_transacciones long, ingresos_total double, rating_promedio double",
    "analisis_categorias": "categoria string, num_ventas long, total_unidades long, ingresos_total double, "
                           "precio_promedio double, pct_ventas double",
    "analisis_plataformas": "plataforma string, num_ventas long, total_unidades long, ingresos_total double, "
                            "ticket_promedio double, cuota_mercado_pct double, stock_actual long",
    "reportes_mensuales": "anio int, mes int, nombre_mes string, num_transacciones long, total_unidades long, "
                          "ingresos_mes double, ticket_promedio double, clientes_unicos long, juego_top string, "
                          "categoria_top string, plataforma_top string, observacion string",
    "perfil_clientes": "cliente_id string, nombre string, nivel_membresia string, distrito string, "
                       "num_compras long, gasto_total double, ticket_promedio double, ultima_compra string",
    "alertas_inventario": "juego_id string, titulo string, plataforma string, stock int, umbral int, precio double",
}


def read_back(spark: SparkSession, root: str, name: str, columns: Sequence[str],
              order: Sequence[Column | str] = (), schema: T.StructType | str | None = None) -> DataFrame:
    """Read a written document collection back, projected and ordered.
    The collections of ``COLLECTION_SCHEMAS`` are read without inference."""
    schema = schema or COLLECTION_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.json(f"{root.rstrip('/')}/{name}").select(*columns)
    return df.orderBy(*order) if order else df


def chart_series(df: DataFrame, serie: str, label: Column | str, value: Column | str,
                 money: bool = True, prefix: str = "S/") -> DataFrame:
    """(serie, etiqueta, valor, texto) rows for a chart; money values
    are labelled 'S/1,234', counts '1,234'."""
    v = F.col(value) if isinstance(value, str) else value
    text = money_label(v, prefix) if money else F.format_number(v, 0)
    return df.select(F.lit(serie).alias("serie"),
                     (F.col(label) if isinstance(label, str) else label).alias("etiqueta"),
                     v.cast("double").alias("valor"), text.alias("texto"))


def charts_of(products: DataFrame, platforms: DataFrame, months: DataFrame, customers: DataFrame,
              low_stock: DataFrame) -> DataFrame:
    """The five chart series of the KPI report, from the KPI tables."""
    month = F.concat(F.col("anio").cast("string"), F.lit("-"),
                     F.lpad(F.col("mes").cast("string"), 2, "0"))
    stock_label = F.concat(F.col("titulo"), F.lit(" ("), F.col("plataforma"), F.lit(")"))
    return (chart_series(products, "top_juegos", "titulo", "total_unidades", money=False)
            .unionByName(chart_series(platforms, "plataformas", "plataforma", "ingresos_total"))
            .unionByName(chart_series(months.filter(present("anio", "mes")), "ventas_mensuales", month, "ingresos_mes"))
            .unionByName(chart_series(customers, "top_clientes", "nombre", "gasto_total"))
            .unionByName(chart_series(low_stock, "stock_bajo", stock_label, "stock", money=False)))


def kpi_charts(wide: DataFrame, inventory: DataFrame) -> DataFrame:
    """The chart series over the wide sales table."""
    return charts_of(kpis.kpi_top_products(wide), kpis.kpi_platforms(wide, inventory), kpis.monthly_totals(wide),
                     kpis.kpi_top_customers(wide), kpis.low_stock_rows(inventory))


# Schemas of the exported KPI CSV folders the chart series are read from.
KPI_FILE_SCHEMAS = {
    "top_juegos": "juego_id string, titulo string, categoria string, total_unidades long, "
                  "num_transacciones long, ingresos_total double, rating_promedio double",
    "plataformas": "plataforma string, num_ventas long, total_unidades long, ingresos_total double, "
                   "ticket_promedio double, cuota_mercado_pct double, stock_actual long",
    "ventas_mensuales": "anio int, mes int, num_transacciones long, total_unidades long, "
                        "ingresos_mes double, ticket_promedio double, clientes_unicos long",
    "top_clientes": "cliente_id string, nombre string, nivel_membresia string, distrito string, "
                    "num_compras long, gasto_total double, ticket_promedio double, ultima_compra date",
    "stock_bajo": "juego_id string, titulo string, plataforma string, stock int, umbral int, precio double",
}


def charts_from_kpi_files(spark: SparkSession, kpi_root: str) -> DataFrame:
    """C1 from the exported KPI CSV folders (S8): every part file of each
    folder is read with a fixed schema, then turned into chart series --
    the same rows as ``kpi_charts`` over the wide table."""
    def read(name):
        return spark.read.option("header", True).schema(KPI_FILE_SCHEMAS[name]).csv(
            f"{kpi_root.rstrip('/')}/{name}")
    return charts_of(*(read(n) for n in ("top_juegos", "plataformas", "ventas_mensuales", "top_clientes", "stock_bajo")))
