"""End-to-end batch and stream jobs over one data folder.

The batch job runs integration, KPIs and document load in sequence:
build the wide sales table once and write it as Parquet partitioned by
(anio, mes) -- the lineage cut every KPI then reads from -- compute the
KPIs and documents from that table, write them as document collections
(counted while written), and finish with the run-metadata document.  Each
step is also callable alone (``write_wide``, ``write_kpis``,
``register_views``).  The stream job decodes, enriches and summarises the
sale-event messages micro-batch by micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.operators import documents
from shopflow.plans.context import Retail, WrittenSales
from shopflow.plans.tables import COLLECTIONS, KPIS, charts
from shopflow.session import work_path
from shopflow.schemas import MESSAGE
from shopflow.sinks import files as sinks
from shopflow.sources import files as sources
from shopflow.sources import tables
from shopflow.streaming import events as streaming

WIDE_PARTITIONS = ["anio", "mes"]
# KPI tables whose size is bounded by a small domain (top-k, categories,
# platforms, months, membership x payment, one summary row)
BOUNDED_KPIS = {"top_juegos", "categorias", "plataformas", "ventas_mensuales", "top_clientes",
                "pago_membresia", "resumen_ejecutivo"}


def write_wide(r: Retail, path: str) -> int:
    """The integration step: clean, join, write.

    A rebalance on the partition columns before the partitioned write gives
    few, evenly sized files per (anio, mes) folder: AQE splits a month that
    holds a large share of the sales and merges small ones, where a plain
    write would leave every task a file in every month it touches."""
    wide, obs = sinks.count_of(r.wide, "ventas_enriquecidas")
    sinks.write_parquet(wide.hint("rebalance", *WIDE_PARTITIONS), path, WIDE_PARTITIONS)
    return obs.get["n"]  # counted while writing, no second pass


def kpi_tables(spark: SparkSession, wide_path: str, inventory: DataFrame) -> dict[str, DataFrame]:
    """The eight KPIs over the written wide table."""
    facts = WrittenSales(spark.read.parquet(wide_path), inventory)
    return {name: table(facts) for name, table in KPIS.items()}


def write_kpi_documents(facts, root: str, extra: dict[str, DataFrame] | None = None) -> dict[str, int]:
    """The document step: the seven collections (and ``extra`` ones), counted while written; the one that holds every
    sale comes last, when the others' shuffles are gone."""
    collections = {**{n: c(facts) for n, c in COLLECTIONS.items()}, **(extra or {})}
    counts = sinks.write_collections({n: collections[n] for n in sorted(collections, key=lambda n: n == "ventas_procesadas")}, root)
    return {n: counts[n] for n in collections}


def register_views(spark: SparkSession, wide_path: str, inventory_path: str,
                   names: tuple[str, str] = ("ventas", "inventario")) -> None:
    """The written wide sales table and inventory as temp views, so SQL
    text written against the shop's tables runs unchanged (same column
    names as the integrated sales table)."""
    sources.register(spark.read.parquet(wide_path), names[0])
    sources.register(spark.read.parquet(inventory_path), names[1])


def write_kpis(spark: SparkSession, wide_path: str, inventory_path: str, out_root: str) -> dict:
    """The KPI step alone, from an already written wide table: the eight
    KPI tables as CSV (bounded ones as one file, plain decimals)."""
    inventory = spark.read.parquet(inventory_path)
    out = {}
    for name, df in kpi_tables(spark, wide_path, inventory).items():
        path = f"{out_root.rstrip('/')}/{name}"
        sinks.write_csv(df, path, single=name in BOUNDED_KPIS, plain=True)
        out[name] = path
    return out


def run_batch(spark: SparkSession, source: "str | Retail", out_root: str | None = None) -> dict:
    """Run integration, KPIs and document load; return the output paths.

    ``source`` is a test-table folder or a ``Retail`` context -- e.g.
    ``RawFiles(spark, "/data/raw")`` for the shop's raw CSV/JSON/TXT/XML."""
    r = source if isinstance(source, Retail) else Retail(spark, source)
    root = out_root or work_path(spark, "batch")
    wide_path = f"{root}/ventas_enriquecidas"
    n_sales = write_wide(r, wide_path)
    sinks.write_parquet(r.inventory, f"{root}/inventario")
    sinks.write_parquet(r.scores, f"{root}/puntuaciones")
    sinks.write_csv(r.activity, f"{root}/actividad_logs")
    inventory = spark.read.parquet(f"{root}/inventario")
    out = {"ventas_enriquecidas": wide_path, "inventario": f"{root}/inventario"}
    # one file for the KPI tables bounded by a small domain; the low-stock
    # list grows with the inventory and keeps its parts
    out.update(write_kpis(spark, wide_path, f"{root}/inventario", f"{root}/kpis"))
    facts = WrittenSales(spark.read.parquet(wide_path), inventory)
    written = write_kpi_documents(facts, f"{root}/documentos", {
        "perfil_productos": documents.product_profile(r.games, facts.wide, spark.read.parquet(f"{root}/puntuaciones")),
        "series_graficos": charts(facts),
    })
    for name in written:
        out[name] = f"{root}/documentos/{name}"
    sources = {
        "ventas.csv": ("CSV", r.raw_sales), "clientes.csv": ("CSV", r.raw_customers),
        "catalogo_juegos.json": ("JSON", r.raw_catalog), "resenas.json": ("JSON", r.raw_reviews),
        "logs_tienda.txt": ("TXT", r.log_lines), "inventario.xml": ("XML", r.raw_inventory),
    }
    counts = F.array(*[F.struct(F.lit(k).alias("coleccion"), F.lit(v).cast("long").alias("documentos"))
                       for k, v in written.items()])
    meta = sinks.run_metadata(spark, sources, list(written)).withColumns({
        "ventas_procesadas": F.lit(n_sales).cast("long"),
        "documentos_por_coleccion": counts})
    out["pipeline_metadata"] = sinks.write_documents(meta, f"{root}/documentos", "pipeline_metadata")
    return out


#: Messages of one file of a staged topic: a task reads whole files, few at a time.
FILE_MESSAGES = 25_000
#: More files than a delivery has, so that each is one micro-batch.
WHOLE_DELIVERY = 1_000_000_000
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def write_topic(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Messages as files of a topic, written where they are: no shuffle, and the number of files grows with them."""
    messages.select("key", "value", "timestamp").write.mode(mode).option("maxRecordsPerFile", FILE_MESSAGES).parquet(path)


def run_deliveries(spark: SparkSession, messages: DataFrame, delivery: Column, n: int, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Write ``messages`` as deliveries 0..n-1 of a topic and run the job that ``start`` begins on a stream after
    each of them: a delivery is one micro-batch, whatever its files. Restarted from its checkpoint the job goes on as
    one that never stopped: the batch without data that moves the watermark on comes after the last delivery only."""
    topic, setting = work_path(spark, "topic"), spark.conf.get(NO_DATA_BATCHES, "true")
    try:
        for i in range(n):
            write_topic(messages.where(delivery == i), topic)
            spark.conf.set(NO_DATA_BATCHES, setting if i == n - 1 else "false")  # a query keeps the settings of its start
            streaming.run_for(start(sources.read_stream(spark, "parquet", path=topic, schema=MESSAGE, per_trigger=WHOLE_DELIVERY)), None)
    finally:
        spark.conf.set(NO_DATA_BATCHES, setting)


def stage_topic(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the sale messages as a Parquet "topic", the shape a partitioned
    broker topic gives the stream source."""
    write_topic(tables.sale_messages(spark, sf_dir), path, "overwrite")


def run_stream(spark: SparkSession, sf_dir: str, out_root: str, checkpoint: str,
               run_id: str, source: dict | None = None, trigger: dict | None = None,
               seconds: float | None = None, dedupe_within: str | None = None,
               dim_buckets: int | None = None, per_trigger: int | None = None):
    """The stream job: messages -> decode -> enrich -> per-batch
    summaries, alerts, events and rejects under ``out_root``.

    The customer dimension is cleaned once and written as Parquet; each
    micro-batch reads that table instead of recomputing it; with
    ``dim_buckets`` it is written bucketed by cliente_id, so a dimension
    beyond the broadcast bound is joined without being re-shuffled in every
    batch.  ``source``
    picks the message source: ``{"format": "kafka", "options": {...}}`` on
    a cluster with the connector, by default the messages derived from the
    events table are staged as a Parquet "topic" first.  ``per_trigger``
    bounds a micro-batch (offsets or files; see ``read_stream``).  ``sf_dir``
    may be a ``RawFiles`` context: then customers come from the raw files and
    ``source`` must be given."""
    r = sf_dir if isinstance(sf_dir, Retail) else Retail(spark, sf_dir)
    sf_dir = r.sf_dir
    dim_path = f"{out_root.rstrip('/')}/dim_clientes"
    if dim_buckets:
        # too big to broadcast: bucket it once, every micro-batch joins it
        # without re-shuffling the dimension
        dim = sinks.write_bucketed(r.customers, f"dim_clientes_{run_id}", "cliente_id",
                                   dim_buckets, dim_path)
    else:
        sinks.write_parquet(r.customers, dim_path)
        dim = spark.read.parquet(dim_path)
    if source is None:
        topic = f"{out_root.rstrip('/')}/topic"
        stage_topic(spark, sf_dir, topic)
        stream = sources.read_stream(spark, "parquet", path=topic, schema=MESSAGE, per_trigger=per_trigger)
    else:
        stream = sources.read_stream(spark, source["format"], source.get("options"),
                                     path=source.get("path"), per_trigger=per_trigger)
    q = streaming.start_batches(stream, f"{out_root.rstrip('/')}/stream", checkpoint, run_id,
                                trigger=trigger, dim=dim, dedupe_within=dedupe_within)
    return streaming.run_for(q, seconds)
