"""The registered queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.columns import RISK_THRESHOLD, canonical_platform
from shopflow.operators import cleanse, documents, kpis, logs, quality, windows
from shopflow.plans import incremental, jobs, live, staged, stored
from shopflow.plans.context import RawFiles, Retail, WrittenSales
from shopflow.plans.tables import COLLECTIONS, KPIS, charts
from shopflow.schemas import CATALOG, CORRUPT, CUSTOMERS, EVENT, INVENTORY_XML
from shopflow.session import work_path
from shopflow.sinks import files as sinks
from shopflow.sources import files as sources
from shopflow.sources import tables
from shopflow.sources.tables import session_key
from shopflow.streaming import events as streaming

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Retail], DataFrame]):
        REGISTRY[name] = lambda spark, sf_dir: fn(Retail(spark, sf_dir))
        REGISTRY[name].__doc__ = fn.__doc__
        return fn
    return deco


def _as_text(df: DataFrame) -> DataFrame:
    """Arrays as '|'-joined text, so that their content is compared."""
    return df.select(*[F.array_join(c, "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


@query("clean_sales")
def clean_sales(r: Retail) -> DataFrame:
    """The cleansed sales table."""
    return r.sales


@query("rejected_sales")
def rejected_sales(r: Retail) -> DataFrame:
    """Sales that cannot be counted, each row with its reason."""
    return cleanse.rejected_sales(r.raw_sales)


@query("rejected_rows")
def rejected_rows(r: Retail) -> DataFrame:
    """Raw CSV, JSON and XML records that do not fit their schema."""
    root = work_path(r.spark, "damaged")
    tables.write_damaged_files(r.spark, r.sf_dir, root)
    return RawFiles(r.spark, root, json_lines=True).rejected_rows


@query("dedupe_latest")
def dedupe_latest(r: Retail) -> DataFrame:
    """P8 on raw sales: the latest row per venta_id by a total order."""
    return cleanse.dedupe(r.raw_sales.filter(F.col("venta_id").isNotNull()), ["venta_id"], ["fecha"], latest=True)


@query("canonical_platform")
def canonical_platform_q(r: Retail) -> DataFrame:
    """Every raw platform spelling of sales, catalogue and inventory,
    with its canonical label and row count."""
    def spellings(df: DataFrame, src: str, col: str = "plataforma") -> DataFrame:
        return (df.groupBy(F.col(col).alias("plataforma_original")).agg(F.count(F.lit(1)).alias("filas"))
                  .select(F.lit(src).alias("fuente"), "plataforma_original",
                          canonical_platform("plataforma_original").alias("plataforma"), "filas"))
    cat = r.raw_catalog.select(F.explode("plataformas").alias("plataforma"))
    return (spellings(r.raw_sales, "ventas")
            .unionByName(spellings(cat, "catalogo"))
            .unionByName(spellings(r.raw_inventory, "inventario")))


@query("catalog_exploded")
def catalog_exploded(r: Retail) -> DataFrame:
    """One row per game x canonical platform."""
    return _as_text(r.catalog)


@query("review_scores")
def review_scores(r: Retail) -> DataFrame:
    """A1: per-game review score, count and useful votes."""
    return r.scores


@query("log_activity")
def log_activity(r: Retail) -> DataFrame:
    """Purchases and sessions per customer from the log."""
    return r.activity


@query("wide_sales")
def wide_sales(r: Retail) -> DataFrame:
    """The integrated wide sales table (tags as text)."""
    return _as_text(r.wide)


# Each KPI sums the sales by the keys it needs, joins only the dimensions it
# reads, and sums again (see plans.tables).
def _kpi(name: str, table: str, doc: str) -> None:
    def fn(r: Retail) -> DataFrame:
        return KPIS[table](r)
    fn.__doc__ = doc
    query(name)(fn)


_kpi("kpi_top_products", "top_juegos", "KPI1 (A4, O1): the ten best-selling games by units.")
_kpi("kpi_categories", "categorias", "KPI2 (A5, W1): sales per category and share of classified sales.")
_kpi("kpi_platforms", "plataformas", "KPI3 (A6, A12, J6, W1): platforms, market share, true stock.")
_kpi("kpi_monthly", "ventas_mensuales", "KPI4 (A7): monthly sales with distinct customers.")
_kpi("kpi_top_customers", "top_clientes", "KPI5 (A8, O1): the ten customers with the highest spend.")
_kpi("kpi_payment_by_segment", "pago_membresia", "KPI6 (A9, O3): payment methods per membership level.")
_kpi("kpi_low_stock", "stock_bajo", "KPI7 (A10, F2): stock at or below the reorder threshold.")
_kpi("kpi_summary", "resumen_ejecutivo", "KPI8 (A11): the one-row executive summary.")


def _written(r: Retail) -> WrittenSales:
    """The wide table and inventory, written once and read back."""
    root = work_path(r.spark, "wide")
    staged.write_wide(r, f"{root}/wide")
    sinks.write_parquet(r.inventory, f"{root}/inventory")
    return WrittenSales(r.spark.read.parquet(f"{root}/wide"), r.spark.read.parquet(f"{root}/inventory"))


@query("kpi_order")
def kpi_order(r: Retail) -> DataFrame:
    """O1-O3, K2: the row order of the bounded KPI tables, read from their
    single CSV files line by line: (kpi, orden, inicio of the line)."""
    root, out = work_path(r.spark, "kpis"), None
    facts = _written(r)
    for name in ("plataformas", "categorias", "ventas_mensuales", "pago_membresia", "top_clientes"):
        sinks.write_csv(KPIS[name](facts), f"{root}/{name}", single=True, header=False, plain=True)
        parts = F.split("value", ",")
        start = F.concat_ws("|", parts[0], parts[1]) if name in ("pago_membresia", "ventas_mensuales") else parts[0]
        one = sources.read_lines(r.spark, f"{root}/{name}").select(
            F.lit(name).alias("kpi"), (F.monotonically_increasing_id() + 1).alias("orden"), start.alias("inicio"))
        out = one if out is None else out.unionByName(one)
    return out


@query("risk_flags")
def risk_flags(r: Retail) -> DataFrame:
    """The derived risk flag of every sale event."""
    events = cleanse.add_flag(r.sale_events, "riesgo_fraude", RISK_THRESHOLD, "alto_riesgo")
    return events.select("event_id", "riesgo_fraude", "alto_riesgo")


# --- W2-W4 ------------------------------------------------------------------


@query("revenue_share")
def revenue_share(r: Retail) -> DataFrame:
    """Category revenue and its share of the classified revenue."""
    return windows.revenue_share(r.items(), "categoria")


@query("monthly_best")
def monthly_best(r: Retail) -> DataFrame:
    """Best game, category and platform of every month."""
    return windows.monthly_best(r.items("anio", "mes"))


@query("monthly_vs_mean")
def monthly_vs_mean(r: Retail) -> DataFrame:
    """Each month's revenue against the mean month."""
    return windows.monthly_vs_mean(r.sales)


# --- Q1-Q4 ------------------------------------------------------------------
@query("null_profile")
def null_profile(r: Retail) -> DataFrame:
    """Q1: NULL count of every column of the wide sales table."""
    return quality.null_profile(r.wide)


@query("validate_documents")
def validate_documents(r: Retail) -> DataFrame:
    """Q2: game documents checked for required fields and types."""
    return quality.document_report(tables.game_documents(r.spark, r.sf_dir))


@query("validate_values")
def validate_values(r: Retail) -> DataFrame:
    """Q2: the catalogue's required fields and value rules."""
    return quality.validation_report(r.games, "juego_id", quality.game_rules() + quality.value_rules())


@query("key_uniqueness")
def key_uniqueness(r: Retail) -> DataFrame:
    """Q3: rows, keys and repeated rows of the unique keys."""
    return quality.key_uniqueness(r.raw_sales, "ventas_procesadas", "venta_id").unionByName(
        quality.key_uniqueness(r.raw_catalog, "juegos", "juego_id"))


@query("duplicate_keys")
def duplicate_keys(r: Retail) -> DataFrame:
    """Q3: venta_id values delivered more than once."""
    return quality.duplicate_keys(r.raw_sales, ["venta_id"])


@query("orphan_keys")
def orphan_keys(r: Retail) -> DataFrame:
    """Q4: sale keys without a partner -- (game, platform) pairs missing from
    the catalogue and customers missing from the customer file."""
    pairs = quality.orphan_keys(r.sales, r.catalog, ["juego_id", "plataforma"]).select(
        F.lit("juego_plataforma").alias("entidad"),
        F.concat_ws("|", "juego_id", "plataforma").alias("clave"), "filas")
    cust = quality.orphan_keys(r.sales, r.customers, ["cliente_id"]).select(
        F.lit("cliente").alias("entidad"), F.col("cliente_id").alias("clave"), "filas")
    return pairs.unionByName(cust)


# --- D1-D3, C1, R1 ----------------------------------------------------------
@query("product_profile_docs")
def product_profile_docs(r: Retail) -> DataFrame:
    """Game documents with nested metrics, flattened for comparison."""
    d = documents.product_profile(r.games, r.sales, r.scores)
    return _as_text(d.select(*[c for c in d.columns if c != "metricas"], "metricas.*"))


@query("monthly_report_docs")
def monthly_report_docs(r: Retail) -> DataFrame:
    """D3: the monthly report documents."""
    return COLLECTIONS["reportes_mensuales"](r)


@query("sales_docs")
def sales_docs(r: Retail) -> DataFrame:
    """One document per sale, date as text."""
    return documents.sales_documents(r.wide)


@query("chart_series")
def chart_series(r: Retail) -> DataFrame:
    """The chart series with their display labels."""
    return charts(r)


def _sources(r: Retail) -> dict[str, tuple[str, DataFrame]]:
    return {
        "ventas.csv": ("CSV", r.raw_sales),
        "clientes.csv": ("CSV", r.raw_customers),
        "catalogo_juegos.json": ("JSON", r.raw_catalog),
        "resenas.json": ("JSON", r.raw_reviews),
        "logs_tienda.txt": ("TXT", r.log_lines),
        "inventario.xml": ("XML", r.raw_inventory),
    }


@query("run_metadata")
def run_metadata(r: Retail) -> DataFrame:
    """The run-metadata document, one row per source; the run time and
    the engine version are left out."""
    meta = sinks.run_metadata(r.spark, _sources(r), list(COLLECTIONS))
    return meta.select("pipeline", "version", "estado", F.array_join("colecciones_creadas", "|").alias("colecciones"),
                       F.col("tecnologias.ingesta").alias("ingesta"), F.col("tecnologias.almacenamiento").alias("almacenamiento"),
                       F.explode("fuentes").alias("f")).select("*", "f.*").drop("f")


@query("output_inventory")
def output_inventory(r: Retail) -> DataFrame:
    """K4/K6: the batch job's document step over the written wide table, its
    seven collections counted back."""
    root = work_path(r.spark, "documents")
    jobs.write_kpi_documents(_written(r), root)
    return sinks.output_inventory(r.spark, root, list(COLLECTIONS))


def _read_back(r: Retail, name: str, columns: list[str], order: list) -> DataFrame:
    """One collection written as documents, then read back."""
    root = work_path(r.spark, "documents")
    sinks.write_documents(COLLECTIONS[name](r), root, name)
    return documents.read_back(r.spark, root, name, columns, order)


@query("read_back_platforms")
def read_back_platforms(r: Retail) -> DataFrame:
    """Platforms by sales, with their market share."""
    return _read_back(r, "analisis_plataformas", ["plataforma", "num_ventas", "cuota_mercado_pct"], [F.desc("num_ventas")])


@query("read_back_games")
def read_back_games(r: Retail) -> DataFrame:
    """Best-selling games by units."""
    return _read_back(r, "analisis_juegos", ["juego_id", "titulo", "categoria", "total_unidades", "num_transacciones",
                                             "ingresos_total", "rating_promedio"], [F.desc("total_unidades")])


@query("read_back_months")
def read_back_months(r: Retail) -> DataFrame:
    """Revenue by month."""
    return _read_back(r, "reportes_mensuales", ["anio", "mes", "ingresos_mes"], ["mes"])


@query("read_back_alerts")
def read_back_alerts(r: Retail) -> DataFrame:
    """Stock alerts, lowest stock first."""
    return _read_back(r, "alertas_inventario", ["juego_id", "titulo", "plataforma", "stock", "umbral", "precio"], ["stock"])


@query("read_back_customers")
def read_back_customers(r: Retail) -> DataFrame:
    """Customers by spend."""
    return _read_back(r, "perfil_clientes", ["cliente_id", "nombre", "nivel_membresia", "distrito", "num_compras",
                                             "gasto_total", "ticket_promedio", "ultima_compra"], [F.desc("gasto_total")])


@query("sql_views")
def sql_views(r: Retail) -> DataFrame:
    """SQL text over the written tables registered as views."""
    facts = _written(r)
    sources.register(facts.wide, "ventas")
    sources.register(facts.inventory, "inventario")
    return r.spark.sql("""
        SELECT v.plataforma, v.ventas, v.clientes, coalesce(i.juegos, 0) AS juegos_en_stock
        FROM (SELECT plataforma, count(venta_id) AS ventas, count(DISTINCT cliente_id) AS clientes FROM ventas GROUP BY plataforma) v
        LEFT JOIN (SELECT plataforma, count(*) AS juegos FROM inventario WHERE stock > umbral GROUP BY plataforma) i
          ON i.plataforma = v.plataforma""")


# --- S1-S5, S8, K1-K3: source and sink round trips ---------------------------
@query("xml_inventory")
def xml_inventory(r: Retail) -> DataFrame:
    """Inventory written as nested XML, read back one row per
    game x platform."""
    path = work_path(r.spark, "xml")
    sinks.write_xml(tables.inventory_nested(r.spark, r.sf_dir), path, "juego", "inventario")
    return sources.read_xml_nested(
        r.spark, path, "juego", INVENTORY_XML, "plataformas.plataforma",
        {"juego_id": "_id", "titulo_inv": "titulo", "plataforma": "item._nombre",
         "stock": "item.stock", "precio_inv": "item.precio", "umbral": "item.umbral_reposicion"})


@query("json_catalog")
def json_catalog(r: Retail) -> DataFrame:
    """Catalogue written as JSON Lines, read back with a fixed schema."""
    path = work_path(r.spark, "json")
    r.raw_catalog.write.json(path)
    df = sources.read_json(r.spark, path, CATALOG, multiline=False)
    return _as_text(df.withColumn("corrupto", F.col(CORRUPT).isNotNull()).drop(CORRUPT))


@query("json_array_catalog")
def json_array_catalog(r: Retail) -> DataFrame:
    """Catalogue as multi-line JSON arrays, read with a fixed schema."""
    path = work_path(r.spark, "json-arrays")
    sinks.write_json_arrays(r.raw_catalog, path)
    return _as_text(sources.read_json(r.spark, path, CATALOG).drop(CORRUPT))


@query("log_from_text")
def log_from_text(r: Retail) -> DataFrame:
    """S3: the activity log written as text lines and counted from the files."""
    path = work_path(r.spark, "log")
    r.log_lines.write.text(path)
    return logs.log_activity(sources.read_lines(r.spark, path))


@query("charts_from_csv")
def charts_from_csv(r: Retail) -> DataFrame:
    """Chart series from the exported KPI CSV folders."""
    root, facts = work_path(r.spark, "kpi-csv"), _written(r)
    for name in ("top_juegos", "plataformas", "ventas_mensuales", "top_clientes", "stock_bajo"):
        sinks.write_csv(KPIS[name](facts), f"{root}/{name}", single=name in jobs.BOUNDED_KPIS, plain=True)
    return documents.charts_from_kpi_files(r.spark, root)


@query("csv_folder")
def csv_folder(r: Retail) -> DataFrame:
    """The log activity written as a folder of CSV parts, read back."""
    path = work_path(r.spark, "csv-folder")
    sinks.write_csv(r.activity, path)
    return sources.read_csv_dir(r.spark, path, r.activity.schema)


@query("csv_roundtrip")
def csv_roundtrip(r: Retail) -> DataFrame:
    """Customers written as CSV (blanks kept), read back."""
    path = work_path(r.spark, "csv")
    sinks.write_csv(r.raw_customers, path)
    return sources.read_csv(r.spark, path, CUSTOMERS).drop(CORRUPT)


@query("parquet_roundtrip")
def parquet_roundtrip(r: Retail) -> DataFrame:
    """Wide sales written as Parquet partitioned by (anio, mes), read
    back."""
    path = work_path(r.spark, "parquet")
    staged.write_wide(r, path, _as_text, ["anio", "mes"])
    return sources.read_parquet(r.spark, path)


@query("encode_messages")
def encode_messages(r: Retail) -> DataFrame:
    """Sale events as keyed JSON messages, parsed back."""
    m = sinks.encode_messages(tables.sale_events(r.spark, r.sf_dir), key="venta_id",
                              timestamp="timestamp", exclude=["_damage"])
    ev = F.from_json("value", EVENT).alias("e")
    return m.select("key", ev).select("key", "e.*")


# --- T-S1..T-S9: the message stream ----------------------------------------
_STREAM_RUNS: dict[tuple, str] = {}


def stream_outputs(r: Retail) -> str:
    """Run the micro-batch job over the messages in three deliveries (one a
    batch), return the output root.  One run per session and content of the
    folder."""
    spark = r.spark
    key = (*session_key(spark), r.sf_dir, *sorted(tables.table(spark, r.sf_dir, "events").inputFiles()))
    if key not in _STREAM_RUNS:
        out, ckpt = work_path(spark, "stream"), work_path(spark, "stream-ckpt")
        jobs.run_deliveries(spark, tables.sale_messages(spark, r.sf_dir), live.event_number() % 3, 3,
                            lambda stream: streaming.start_batches(stream, out, ckpt, run_id="r0", dim=r.customers))
        _STREAM_RUNS[key] = out
    return _STREAM_RUNS[key]


def _stream_result(r: Retail, name: str) -> DataFrame:
    df = r.spark.read.parquet(f"{stream_outputs(r)}/{name}")
    return df.withColumn("batch_id", F.col("batch_id").cast("long")).drop("run_id")


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("stream_by_platform")
def stream_by_platform(r: Retail) -> DataFrame:
    """Per-batch summary by platform."""
    return _stream_result(r, "summary_by_platform")


@query("stream_by_payment")
def stream_by_payment(r: Retail) -> DataFrame:
    """Per-batch summary by payment method."""
    return _stream_result(r, "summary_by_payment")


@query("stream_alerts")
def stream_alerts(r: Retail) -> DataFrame:
    """F5/T-S8: fraud alerts."""
    return _ntz(_stream_result(r, "alerts"), "event_timestamp")


@query("stream_enriched")
def stream_enriched(r: Retail) -> DataFrame:
    """J7/T-S9: valid events enriched with customer data or defaults."""
    return _ntz(_stream_result(r, "events"), "event_timestamp").select(
        "event_id", "event_type", "event_timestamp", "venta_id", "cliente_id", "juego_id",
        "plataforma", "metodo_pago", "vendedor", "precio", "cantidad", "total",
        "cliente_nombre", "nivel_membresia", "distrito", "riesgo_fraude", "venta_riesgosa", "batch_id")


@query("stream_rejects")
def stream_rejects(r: Retail) -> DataFrame:
    """T-S2/T9: messages whose value does not fit the event schema, with their text."""
    return _stream_result(r, "rejects").select("message_key", "message_value", "batch_id")


# --- the live jobs: windows, stock, life cycle, customers as of event time; deliveries and stored summaries of the batch side ---
for _name, _fn in {**live.QUERIES, **incremental.QUERIES, **stored.QUERIES}.items():
    query(_name)(_fn)
