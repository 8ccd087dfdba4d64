"""Queries of the live jobs: event-time windows, stock alerts, order life cycle, customers as of event time.

Each stream query stages its messages as a file "topic" in deliveries and runs the
real streaming job over it, one delivery a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.operators import asof
from shopflow.plans import jobs
from shopflow.plans.context import RawFiles, Retail
from shopflow.session import work_path
from shopflow.sinks import files as sinks
from shopflow.sources import tables
from shopflow.streaming import events as streaming
from shopflow.streaming import lifecycle, stock, windows

_RUNS: dict[tuple, str] = {}


def once(r: Retail, name: str, run: Callable[[], str]) -> str:
    """The output folder of a stream run; one run per session and content of the folder."""
    key = (name, *tables.session_key(r.spark), r.sf_dir, *sorted(tables.table(r.spark, r.sf_dir, "events").inputFiles()))
    if key not in _RUNS:
        _RUNS[key] = run()
    return _RUNS[key]


def event_number() -> Column:
    return F.substring("key", 2, 20).cast("long")


def by_decade() -> Column:
    """Deliveries by ten days of the month; some events arrive one or two deliveries late."""
    n = event_number()
    late = F.when(n % 11 == 5, 2).when(n % 7 == 3, 1).otherwise(0)
    return F.least(F.lit(2), F.floor((F.dayofmonth("timestamp") - 1) / 10).cast("int") + late)


def windows_run(r: Retail, name: str, length: str, slide: str | None) -> str:
    def run() -> str:
        out, ckpt = work_path(r.spark, name), work_path(r.spark, "ckpt")
        jobs.run_deliveries(r.spark, tables.sale_messages(r.spark, r.sf_dir), by_decade(), 3,
                            lambda stream: windows.start_windows(stream, out, ckpt, "r0", length=length, slide=slide))
        return out

    return once(r, name, run)


def closed_windows(r: Retail, out: str) -> DataFrame:
    return r.spark.read.parquet(f"{out}/closed").select(
        F.col("ventana_inicio").cast("timestamp_ntz").alias("ventana_inicio"), "plataforma", "ventas", "ingresos", "ticket_promedio",
        "ventas_riesgo", F.col("batch_id").cast("long").alias("batch_id"))


def live_daily_sales(r: Retail) -> DataFrame:
    """T-S3: sales per day and platform, each window once, in the delivery that closed it."""
    return closed_windows(r, windows_run(r, "windows", "1 day", None))


def live_sliding_sales(r: Retail) -> DataFrame:
    """T-S3: sales of seven days, one window beginning each day."""
    return closed_windows(r, windows_run(r, "sliding", "7 days", "1 day"))


def live_late_events(r: Retail) -> DataFrame:
    """T-S3: events that arrived after their day had closed."""
    late = r.spark.read.parquet(f"{windows_run(r, 'windows', '1 day', None)}/late")
    return late.select("event_id", "plataforma", F.col("ventana_inicio").cast("timestamp_ntz").alias("ventana_inicio"), F.col("batch_id").cast("long").alias("batch_id"))


def live_stock_alerts(r: Retail) -> DataFrame:
    """F2, A10 on the stream: each fall of a game's running stock to its reorder threshold."""
    def run() -> str:
        held = work_path(r.spark, "inventory")
        r.inventory.write.parquet(held)
        out, ckpt = work_path(r.spark, "stock-alerts"), work_path(r.spark, "ckpt")
        inventory = r.spark.read.schema(r.inventory.schema).parquet(held)
        jobs.run_deliveries(r.spark, tables.sale_messages(r.spark, r.sf_dir), F.pmod(event_number(), F.lit(3)), 3,
                            lambda stream: stock.start_stock_alerts(stream, inventory, out, ckpt))
        return out

    return r.spark.read.schema(stock.ALERT).parquet(once(r, "stock", run)).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def order_net_revenue(r: Retail) -> DataFrame:
    """A13 with the life cycle: created, paid and cancelled sales, and the revenue that stays."""
    def run() -> str:
        out, ckpt = work_path(r.spark, "orders"), work_path(r.spark, "ckpt")
        jobs.run_deliveries(r.spark, tables.order_messages(r.spark, r.sf_dir), F.col("delivery"), 4,
                            lambda stream: lifecycle.start_life_cycle(stream, out, ckpt))
        return out

    return lifecycle.net_revenue(r.spark.read.parquet(once(r, "orders", run)))


def customer_as_of_event(r: Retail) -> DataFrame:
    """J7, P8 as of event time: each event with the customer's membership and district of that moment."""
    fields = ["nivel_membresia", "distrito"]
    intervals = asof.versions(tables.customer_deliveries(r.customers), "cliente_id", "entrega", fields)
    events, _ = streaming.decode_events(tables.sale_messages(r.spark, r.sf_dir))
    out = asof.as_of_join(events.select("event_id", "cliente_id", "event_timestamp"), intervals, "cliente_id", "event_timestamp")
    return out.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


def stream_csv_customers(r: Retail) -> DataFrame:
    """The stream enriched straight from the customers' CSV file."""
    def run() -> str:
        raw, out, ckpt = work_path(r.spark, "raw"), work_path(r.spark, "stream"), work_path(r.spark, "ckpt")
        sinks.write_csv(r.raw_customers, f"{raw}/clientes.csv")
        customers = RawFiles(r.spark, raw).customers
        jobs.run_deliveries(r.spark, tables.sale_messages(r.spark, r.sf_dir), F.pmod(event_number(), F.lit(3)), 3,
                            lambda stream: streaming.start_batches(stream, out, ckpt, "r0", handlers={"events": lambda b: b}, dim=customers))
        return out

    rows = r.spark.read.parquet(f"{once(r, 'csv', run)}/events")
    return rows.select("event_id", "cliente_id", "cliente_nombre", "nivel_membresia", "distrito", F.col("batch_id").cast("long").alias("batch_id"))


QUERIES: dict[str, Callable[[Retail], DataFrame]] = {f.__name__: f for f in (
    live_daily_sales, live_sliding_sales, live_late_events, live_stock_alerts, order_net_revenue, customer_as_of_event, stream_csv_customers)}
