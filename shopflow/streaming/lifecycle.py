"""A13 with an order life cycle: a sale counts once, when it was paid and not cancelled.

Created orders are joined with their payments and cancellations by stream-stream left
outer joins: an event of the same sale within ``within`` of the creation. Watermarks
bound the state, and a created order without a match comes out when the watermark has
passed its time. Deliveries may repeat an event; ``net_revenue`` counts each sale once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.functions.columns import money
from shopflow.schemas import CORRUPT
from shopflow.streaming.events import parse_events

CREATED, PAID, CANCELLED = "venta_creada", "pago_aprobado", "venta_cancelada"


def life_cycle(events: DataFrame, within: str = "7 days", delay: str = "1 day") -> DataFrame:
    """(venta_id, plataforma, total, creada, pagada, cancelada) of every created order, once it is settled.

    ``events`` is a stream (or a table) of valid events. A payment or cancellation counts from the creation
    on until ``within`` after it.
    """
    def of(kind: str, name: str, *extra: str) -> DataFrame:
        one = events.where((F.col("event_type") == kind) & F.col("venta_id").isNotNull() & F.col("event_timestamp").isNotNull())
        return one.select(F.col("venta_id").alias("venta_id" if extra else f"{name}_id"), F.col("event_timestamp").alias(name), *extra).withWatermark(name, delay)

    out = of(CREATED, "creada", "plataforma", "total")
    for kind, name in ((PAID, "pagada"), (CANCELLED, "cancelada")):
        other = of(kind, name)
        out = out.join(other, F.expr(f"venta_id = {name}_id AND {name} >= creada AND {name} <= creada + INTERVAL {within}"), "left").drop(f"{name}_id")
        out = out.withColumn(name, F.col(name).cast("timestamp_ntz"))  # one event time, the creation's, goes on
    return out


def net_revenue(settled: DataFrame) -> DataFrame:
    """Per platform: created, paid, cancelled and unpaid sales, and the revenue of those paid and not cancelled."""
    once = settled.groupBy("venta_id", "creada").agg(
        F.max("plataforma").alias("plataforma"), F.max(money("total")).alias("total"),
        F.count("pagada").alias("pagos"), F.count("cancelada").alias("cancelaciones"))
    paid, cancelled = F.col("pagos") > 0, F.col("cancelaciones") > 0
    return once.groupBy("plataforma").agg(
        F.count(F.lit(1)).alias("creadas"), F.count_if(paid).alias("pagadas"), F.count_if(cancelled).alias("canceladas"),
        F.count_if(~paid & ~cancelled).alias("sin_respuesta"),
        F.coalesce(F.round(F.sum(F.when(paid & ~cancelled, F.col("total"))), 2).cast("double"), F.lit(0.0)).alias("ingresos_netos"))


def start_life_cycle(stream: DataFrame, out: str, checkpoint: str, *, within: str = "7 days", delay: str = "1 day",
                     trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Start the joins over raw messages; settled orders are appended to ``out``."""
    events = parse_events(stream).where(F.col(CORRUPT).isNull())
    return life_cycle(events, within, delay).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint).trigger(**dict(trigger or {"availableNow": True})).start()
