"""T-S1..T-S9: sale-event stream -- decode, enrich, summarise, alert.

The per-batch handlers are plain DataFrame -> DataFrame functions, so the
same code serves a micro-batch and a batch table.  ``start_batches`` wires
them to a Structured Streaming query with ``foreachBatch``; every output of
batch N goes to ``<out>/<name>/run_id=<run>/batch_id=N`` with overwrite, so a
replayed batch rewrites its own folder instead of appending twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopflow.functions.columns import (
    EVENT_DEFAULTS, RISK_THRESHOLD, canonical_platform, exact_avg, money_avg, money_sum, normalize_key,
)
from shopflow.functions.predicates import risky
from shopflow.schemas import CORRUPT, EVENT, with_corrupt

Handler = Callable[[DataFrame], DataFrame]


def parse_events(raw: DataFrame, schema=EVENT) -> DataFrame:
    """T-S1..T-S3: key/value/timestamp messages -> typed events.

    The JSON value is parsed with a fixed schema; a value that is not valid
    JSON, or holds a wrongly typed field, keeps its text in
    ``_corrupt_record``.  Event time is parsed leniently (bad -> NULL),
    processing time is stamped, the platform is canonicalised as in batch.
    """
    parsed = raw.select(
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("message_value"),
        F.col("timestamp").cast("timestamp").alias("kafka_timestamp"),
        F.from_json(F.col("value").cast("string"), with_corrupt(schema),
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("j"))
    out = parsed.select("message_key", "message_value", "kafka_timestamp", "j.*")
    return out.withColumns({
        CORRUPT: F.when(F.col("message_value").isNull() | F.col(CORRUPT).isNotNull(),
                        F.coalesce(F.col(CORRUPT), F.lit(""))),
        "event_timestamp": F.try_to_timestamp(F.col("event_timestamp")),
        "plataforma": canonical_platform("plataforma"),
        "processing_timestamp": F.current_timestamp(),
    })


def decode_events(raw: DataFrame, schema=EVENT) -> tuple[DataFrame, DataFrame]:
    """(valid events, rejected messages) -- malformed input never becomes a
    row of NULLs inside the summaries."""
    p = parse_events(raw, schema)
    valid = p.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "message_value")
    rejects = p.filter(F.col(CORRUPT).isNotNull()).select(
        "message_key", "message_value", "kafka_timestamp", "processing_timestamp")
    return valid, rejects


def enrich_events(events: DataFrame, dim: DataFrame, key: str = "cliente_id",
                  fields: Mapping[str, str] | None = None,
                  defaults: Mapping[str, str] = EVENT_DEFAULTS) -> DataFrame:
    """J7/T-S9: stream-static left join on the normalised key; each event
    field keeps its own value, else the dimension's, else the default.
    ``fields`` maps event field -> dimension column."""
    fields = dict(fields or {"cliente_nombre": "nombre", "nivel_membresia": "nivel_membresia",
                             "distrito": "distrito"})
    d = dim.select(F.col(key).alias("__k"), *[F.col(v).alias(f"__{k}") for k, v in fields.items()])
    j = events.join(d, normalize_key(events[key]) == d["__k"], "left")
    filled = {k: F.coalesce(F.col(k), F.col(f"__{k}"), F.lit(defaults.get(k)))
              for k in fields}
    return j.withColumns(filled).drop("__k", *[f"__{k}" for k in fields])


def of_types(batch: DataFrame, event_types=None) -> DataFrame:
    """Keep only the given lifecycle types (None keeps every event: each
    lifecycle event then counts, as in the per-event summaries)."""
    return batch if not event_types else batch.filter(F.col("event_type").isin(*event_types))


def stream_by_platform(batch: DataFrame, event_types=None) -> DataFrame:
    """Per platform: events, revenue, mean ticket, risky events, by revenue.
    ``event_types`` restricts the summary, e.g. to completed sales."""
    return of_types(batch, event_types).groupBy("plataforma").agg(
        F.count(F.lit(1)).alias("total_ventas"),
        money_sum("total").alias("ingresos"),
        money_avg("total").alias("ticket_promedio"),
        F.sum(F.col("venta_riesgosa").cast("int")).alias("ventas_riesgo")).orderBy(F.desc("ingresos"), "plataforma")


def stream_by_payment(batch: DataFrame, event_types=None) -> DataFrame:
    """Per payment method: events, amount, mean risk, by amount."""
    return of_types(batch, event_types).groupBy("metodo_pago").agg(
        F.count(F.lit(1)).alias("total_transacciones"),
        money_sum("total").alias("monto_total"),
        exact_avg("riesgo_fraude").alias("riesgo_promedio")).orderBy(F.desc("monto_total"), "metodo_pago")


# Fixed output contract: the columns of an alert.
ALERT_COLUMNS = ["event_id", "venta_id", "cliente_nombre", "plataforma", "metodo_pago",
                 "total", "riesgo_fraude", "event_timestamp"]


def alerts(batch: DataFrame, threshold: float = RISK_THRESHOLD) -> DataFrame:
    """F5/T-S8: flagged or risk >= threshold, riskiest first over the whole
    batch (a range sort of the alerts alone)."""
    return (batch.filter(risky(threshold=threshold)).select(*ALERT_COLUMNS)
                 .orderBy(F.desc("riesgo_fraude"), "event_id"))


def default_handlers() -> dict[str, Handler]:
    return {
        "events": lambda b: b,
        "summary_by_platform": stream_by_platform,
        "summary_by_payment": stream_by_payment,
        "alerts": alerts,
    }


def batch_writer(out_root: str, handlers: Mapping[str, Handler], run_id: str,
                 rejects: Handler | None = None, valid: Handler | None = None):
    """The foreachBatch callback: empty batch -> nothing; else persist the
    batch once, write ``rejects`` of it, and every handler's result over its
    ``valid`` rows (persisted too), each to its own batch folder."""
    root = out_root.rstrip("/")

    def write_out(name: str, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{root}/{name}/run_id={run_id}/batch_id={batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        good = valid(batch).persist() if valid is not None else batch
        try:
            if batch.isEmpty():
                return
            if rejects is not None:
                write_out("rejects", rejects(batch), batch_id)
            for name, fn in handlers.items():
                write_out(name, fn(good), batch_id)
        finally:
            good.unpersist()
            batch.unpersist()

    return write


def dedupe_events(events: DataFrame, key: str = "event_id", time_col: str = "event_timestamp",
                  delay: str = "10 minutes") -> DataFrame:
    """Drop re-delivered events (same ``key``) arriving within ``delay`` of
    each other in event time.  State is bounded by the watermark; events
    later than the watermark are dropped by it.  Rejected messages have no
    key to compare: each gets one of its own and no event time, so none is
    dropped."""
    own = F.when(F.col(CORRUPT).isNotNull() | F.col(key).isNull(), F.concat(F.lit("\x00"), F.uuid())).otherwise(F.col(key))
    timed = F.when(F.col(CORRUPT).isNull(), F.col(time_col))
    return (events.withColumns({"__event_key": own, time_col: timed}).withWatermark(time_col, delay)
            .dropDuplicatesWithinWatermark(["__event_key"]).drop("__event_key"))


def run_for(query: StreamingQuery, seconds: float | None) -> StreamingQuery:
    """T-S6: wait until the query ends by itself (availableNow) or until
    ``seconds`` have passed, then stop it; re-raise its failure."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def start_batches(stream: DataFrame, out_root: str, checkpoint: str, run_id: str,
                  handlers: Mapping[str, Handler] | None = None,
                  trigger: Mapping[str, object] | None = None,
                  dim: DataFrame | None = None,
                  dedupe_within: str | None = None) -> StreamingQuery:
    """K7-K9, T-S4..T-S7: start the micro-batch query.

    ``stream`` holds raw messages (key, value, timestamp).  Each batch is
    decoded once; valid events (enriched against ``dim`` when given) feed
    the handlers, rejected messages go to ``rejects``.  ``trigger`` defaults
    to ``{"availableNow": True}``; pass ``{"processingTime": "10 seconds"}``
    for a long-running job.  ``dedupe_within`` (e.g. "10 minutes") drops
    re-delivered event ids inside that event-time watermark."""
    handlers = dict(handlers or default_handlers())
    parsed = parse_events(stream)
    if dedupe_within:
        parsed = dedupe_events(parsed, delay=dedupe_within)

    def valid(b: DataFrame) -> DataFrame:
        """Valid events, enriched: rejected messages never meet the dimension."""
        good = b.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "message_value")
        return good if dim is None else enrich_events(good, dim)

    def rejected(b: DataFrame) -> DataFrame:
        return b.filter(F.col(CORRUPT).isNotNull()).select(
            "message_key", "message_value", "kafka_timestamp")

    writer = batch_writer(out_root, handlers, run_id, rejects=rejected, valid=valid)
    w = (parsed.writeStream.foreachBatch(writer)
               .option("checkpointLocation", checkpoint)
               .trigger(**dict(trigger or {"availableNow": True})))
    return w.start()
