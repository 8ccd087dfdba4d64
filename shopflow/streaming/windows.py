"""T-S3: live sales by event-time window, closed windows only, late events apart.

Each micro-batch splits its valid events by the watermark (the greatest event time of
earlier batches less ``delay``): events of a window that has closed go to ``late``, the
others are summed per (window, platform) into ``partials``. Then the windows that
the new watermark closes are summed up over all batches and written to ``closed``.
Spark's own windowed aggregate drops late rows unseen; here every valid event is counted
in exactly one of the outputs or still open. Late rows appear once per closed window.

Every output of batch N is a partition of its own that a replay rewrites, and batch N
reads only what batches up to N wrote, so a run that is stopped anywhere gives the
same windows after its restart. A window's rows are sums, never its events, so the state grows
with windows x platforms x batches, and only the closing dates' partitions are read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.functions.columns import money, ratio
from shopflow.schemas import CORRUPT
from shopflow.streaming.events import parse_events


def sums(rows: DataFrame) -> DataFrame:
    """Mergeable sums per window and platform."""
    return rows.groupBy("ventana_inicio", "ventana_fin", "plataforma").agg(
        F.count(F.lit(1)).alias("_ventas"), F.sum(money("total")).alias("_ingresos"), F.count("total").alias("_totales"),
        F.sum(F.coalesce(F.col("venta_riesgosa").cast("int"), F.lit(0))).alias("_riesgo"))


def merged(partials: DataFrame) -> DataFrame:
    """The windows' figures from their partial sums."""
    return partials.groupBy("ventana_inicio", "ventana_fin", "plataforma").agg(
        F.sum("_ventas").alias("ventas"), F.round(F.sum("_ingresos"), 2).cast("double").alias("ingresos"),
        ratio(F.sum("_ingresos"), F.sum("_totales")).alias("ticket_promedio"), F.sum("_riesgo").alias("ventas_riesgo"))


def windowed(events: DataFrame, length: str, slide: str | None) -> DataFrame:
    """One row per event and window that holds it; events without a time belong to none."""
    return (events.where(F.col("event_timestamp").isNotNull())
            .withColumn("_w", F.window("event_timestamp", length, slide or length))
            .withColumns({"ventana_inicio": F.col("_w.start"), "ventana_fin": F.col("_w.end")}).drop("_w"))


def window_writer(out_root: str, run_id: str, length: str, slide: str | None, delay: str):
    """The foreachBatch callback."""
    root = out_root.rstrip("/")
    lag = F.expr(f"INTERVAL {delay}")

    def batch_path(name: str, batch_id: int) -> str:
        return f"{root}/{name}/run_id={run_id}/batch_id={batch_id}"

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = None
        if batch_id:  # batches are numbered without gaps, so the last one's mark sums up all earlier ones
            before = session.read.schema("max_time timestamp").parquet(batch_path("watermark", batch_id - 1)).first()[0]
        # one row per event is kept, not one per event and window, and only the columns that the outputs take
        events = batch.where(F.col(CORRUPT).isNull()).select("event_id", "event_timestamp", "plataforma", "total", "venta_riesgosa").persist()
        rows = windowed(events, length, slide)
        try:
            newest = events.agg(F.max("event_timestamp")).first()[0]
            latest = max((t for t in (before, newest) if t is not None), default=None)
            old, new = ((F.lit(t).cast("timestamp") - lag) for t in (before, latest))
            open_ = F.lit(True) if before is None else F.col("ventana_fin") > old
            rows.where(~open_).select("event_id", "event_timestamp", "plataforma", "total", "ventana_inicio", "ventana_fin").write.mode(
                "overwrite").parquet(batch_path("late", batch_id))
            partials = sums(rows.where(open_)).withColumns({"run_id": F.lit(run_id), "dia_fin": F.to_date("ventana_fin"), "batch_id": F.lit(batch_id).cast("long")})
            partials.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "dia_fin", "batch_id").parquet(f"{root}/partials")
            if latest is not None and (before is None or latest > before):
                held = session.read.schema(partials.schema).parquet(f"{root}/partials").where((F.col("run_id") == run_id) & (F.col("batch_id") <= batch_id))
                closing = held.where((F.col("ventana_fin") <= new) & (F.col("dia_fin") <= F.to_date(new)))
                if before is not None:
                    closing = closing.where((F.col("ventana_fin") > old) & (F.col("dia_fin") >= F.to_date(old)))
                merged(closing).write.mode("overwrite").parquet(batch_path("closed", batch_id))
            session.createDataFrame([(latest,)], "max_time timestamp").coalesce(1).write.mode("overwrite").parquet(batch_path("watermark", batch_id))
        finally:
            events.unpersist()

    return write


def start_windows(stream: DataFrame, out_root: str, checkpoint: str, run_id: str, *, length: str = "1 day", slide: str | None = None,
                  delay: str = "2 days", trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Start the live windows over raw messages; ``slide`` makes them overlap. Rejected messages are left to the event job."""
    writer = window_writer(out_root, run_id, length, slide, delay)
    return (parse_events(stream).writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
            .trigger(**dict(trigger or {"availableNow": True})).start())
