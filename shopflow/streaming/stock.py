"""F2/A10 on the stream: running stock per game and platform, one alert per crossing.

A completed sale takes units, a cancelled one returns them. The stock left of each
(game, platform) is keyed state of ``transformWithState``, started from the inventory;
an alert is given when it falls to the reorder threshold or below, and the next one
only after it has been above. An event-time timer drops the state of a key that was idle
for ``idle``; its next event starts from the inventory again. Events of one micro-batch are
taken in the order of (event time, event id); events more than ``delay`` behind the newest
one are dropped by the watermark. State is one number per key; a hot key's
events pass through its one state in order, as any running total, narrow rows only.
Sales of games that the inventory does not have give no alert.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from shopflow.functions.columns import normalize_key
from shopflow.schemas import CORRUPT
from shopflow.streaming.events import parse_events

KEYS = ["juego_id", "plataforma"]
#: Units taken by an event of each type.
TAKES = {"venta_completada": 1, "venta_cancelada": -1}
ALERT = "juego_id string, plataforma string, event_id string, event_timestamp timestamp, stock long, umbral int"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class StockLevel(StatefulProcessor):
    """The stock left of one key, and the time of its last event."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.left = handle.getValueState("left", "stock long, last_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["event_timestamp", "event_id"], kind="stable").reset_index(drop=True)
        held = self.left.get()
        start, last = (int(batch["stock"].iloc[0]), 0) if held is None else map(int, held)
        last = max(last, int(batch["event_timestamp"].max().timestamp() * 1000))
        after = start - batch["unidades"].cumsum()
        crossed = (after <= batch["umbral"]) & (after.shift(fill_value=start) > batch["umbral"])
        self.left.update((int(after.iloc[-1]), last))
        if held is None:
            self.handle.registerTimer(last + self.idle_ms)
        alerts = batch[crossed]
        yield pd.DataFrame({"juego_id": key[0], "plataforma": key[1], "event_id": alerts["event_id"], "event_timestamp": alerts["event_timestamp"],
                            "stock": after[crossed].astype("int64"), "umbral": alerts["umbral"].astype("int32")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self.left.get()
        if held is not None:
            due = int(held[1]) + self.idle_ms
            if due <= timerValues.getCurrentWatermarkInMs():
                self.left.clear()
            else:  # it had events since the timer was set
                self.handle.registerTimer(due)
        yield pd.DataFrame({c.split()[0]: [] for c in ALERT.split(", ")}).astype(
            {"juego_id": str, "plataforma": str, "event_id": str, "event_timestamp": "datetime64[ns]", "stock": "int64", "umbral": "int32"})

    def close(self) -> None:
        pass


def movements(events: DataFrame, inventory: DataFrame) -> DataFrame:
    """Stock movements of the games in the inventory, each with its key's starting stock and threshold."""
    units = F.element_at(F.create_map(*(F.lit(x) for kv in TAKES.items() for x in kv)), F.col("event_type")) * F.col("cantidad")
    moved = events.where(F.col("event_type").isin(*TAKES) & F.col("cantidad").isNotNull()).select(
        normalize_key("juego_id").alias("juego_id"), "plataforma", "event_id", "event_timestamp", units.cast("long").alias("unidades"))
    start = inventory.groupBy(*KEYS).agg(F.sum("stock").cast("long").alias("stock"), F.max("umbral").alias("umbral"))
    return moved.join(start, KEYS)


def start_stock_alerts(stream: DataFrame, inventory: DataFrame, out: str, checkpoint: str, *, idle: float = 90 * 86400.0,
                       delay: str = "31 days", trigger: Mapping[str, object] | None = None) -> StreamingQuery:
    """Start the alerts over raw messages; ``inventory`` is a written table; ``idle`` is in seconds of event time.

    The file sink commits each batch once.
    """
    spark = stream.sparkSession
    events = parse_events(stream).where(F.col(CORRUPT).isNull() & F.col("event_timestamp").isNotNull()).withWatermark("event_timestamp", delay)
    found = movements(events, inventory).groupBy(*KEYS).transformWithStateInPandas(
        StockLevel(int(idle * 1000)), ALERT, outputMode="append", timeMode="eventTime")
    provider = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # keyed state with timers needs it; a query keeps the settings of its start
    try:
        return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(
            **dict(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.unset(PROVIDER) if provider is None else spark.conf.set(PROVIDER, provider)
