"""Event-time windows, stock alerts, order life cycle, versions of the customer dimension."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from shopflow.operators import asof
from shopflow.plans import jobs
from shopflow.schemas import MESSAGE
from shopflow.streaming import events as st
from shopflow.streaming import lifecycle, stock, windows

DAY = dt.datetime(2024, 1, 1)


def event(i, hours, kind="venta_completada", plat="PS5", total=10.0, game="P1", units=1, sale=None, risky=False):
    body = {"event_id": f"EVT-{i:06d}", "event_type": kind, "event_timestamp": (DAY + dt.timedelta(hours=hours)).isoformat(), "venta_id": sale or f"V{i}",
            "juego_id": game, "plataforma": plat, "cantidad": units, "total": total, "venta_riesgosa": risky}
    return sale or f"V{i}", json.dumps(body), None


def deliver(spark, topic, rows):
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(topic)


def stream(spark, topic):
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(topic)


def closed(spark, out):
    return sorted((r.ventana_inicio, r.plataforma, r.ventas, r.ingresos, r.batch_id) for r in spark.read.parquet(f"{out}/closed").collect())


def test_windows_close_once_late_events_are_kept_and_replays_change_nothing(spark, tmp):
    topic, out, ckpt = (os.path.join(tmp, x) for x in ("topic", "out", "ckpt"))
    first = [event(i, 5 * i, plat="PS5" if i % 2 else "PC") for i in range(20)]  # up to hour 95 of day 4
    second = [event(100, 1), event(101, 60), event(102, 150), ("VX", "not json", None), event(103, 50, total=0.5)]
    third = [event(104, 20), event(105, 400)]
    deliver(spark, topic, first)
    run = lambda: st.run_for(windows.start_windows(stream(spark, topic), out, ckpt, "r", delay="1 day"), 120)
    run()
    assert {r[0].day for r in closed(spark, out)} == {1, 2}  # hour 95 less a day: day 3 is open
    deliver(spark, topic, second)
    deliver(spark, topic, third)
    run()  # a restart from the checkpoint
    late = sorted(r.event_id for r in spark.read.parquet(f"{out}/late").collect())
    assert late == ["EVT-000100", "EVT-000104"]
    got = closed(spark, out)
    assert sum(r[2] for r in got) == 20 + 3  # all but the late ones and the last, which is still open
    assert len({r[:2] for r in got}) == len(got)
    day3 = [r for r in got if r[0].day == 3 and r[1] == "PS5"]
    assert day3[0][2:] == (2 + 2, 2 * 10.0 + 10.0 + 0.5, 1)  # hours 55 and 65, then 60 and 50 of the second delivery
    # batch 1 again, as after a failure before its commit: the same rows
    write = windows.window_writer(out, "r", "1 day", None, "1 day")
    write(st.parse_events(spark.createDataFrame(second, MESSAGE)), 1)
    assert closed(spark, out) == got


def test_windows_without_events(spark, tmp):
    write = windows.window_writer(tmp, "r", "1 day", None, "1 day")
    for i in (0, 1):
        write(st.parse_events(spark.createDataFrame([], MESSAGE)), i)
    write(st.parse_events(spark.createDataFrame([event(1, 0), event(2, 72)], MESSAGE)), 2)
    assert [r[2] for r in closed(spark, tmp)] == [1]


def test_stock_alerts_survive_a_restart_and_come_once_per_crossing(spark, tmp):
    topic, out, ckpt, held = (os.path.join(tmp, x) for x in ("topic", "out", "ckpt", "inventory"))
    spark.createDataFrame([("P1", "PS5", 10, 5), ("P2", "PS5", 3, 5), ("P3", "PC", 100, 5)], "juego_id string, plataforma string, stock int, umbral int").write.parquet(held)
    inventory = spark.read.parquet(held)

    def run():
        st.run_for(stock.start_stock_alerts(stream(spark, topic), inventory, out, ckpt, idle=3600.0 * 24 * 20), 150)
        return sorted((r.event_id, r.stock) for r in spark.read.schema(stock.ALERT).parquet(out).collect())

    deliver(spark, topic, [event(2, 2, units=2), event(1, 1, units=2), event(3, 3, game="P2"), event(4, 4, game="P9"), event(5, 5, kind="venta_creada", units=50)])
    assert run() == []  # 6 left; P2 was below from the start; P9 is not in the inventory
    deliver(spark, topic, [event(6, 6, units=1), event(7, 7, units=1), event(8, 8, kind="venta_cancelada", units=3), event(9, 9, units=2)])
    assert run() == [("EVT-000006", 5), ("EVT-000009", 5)]
    # idle for longer than the timer, moved on by another game's events: the state goes, the inventory's stock holds again
    deliver(spark, topic, [event(20, 24 * 80, game="P3")])
    deliver(spark, topic, [event(21, 24 * 81, game="P3")])
    deliver(spark, topic, [event(22, 24 * 82, units=5)])
    assert run() == [("EVT-000006", 5), ("EVT-000009", 5), ("EVT-000022", 5)]


def test_orders_count_once(spark, tmp):
    topic, out, ckpt = (os.path.join(tmp, x) for x in ("topic", "out", "ckpt"))
    made, paid, gone = lifecycle.CREATED, lifecycle.PAID, lifecycle.CANCELLED
    rows = [event(1, 0, made, sale="A"), event(2, 5, paid, sale="A"), event(2, 5, paid, sale="A"),  # paid, delivered twice
            event(3, 1, made, sale="B"), event(4, 9, paid, sale="B"), event(5, 30, gone, sale="B"),  # paid, then cancelled
            event(6, 2, made, sale="C"), event(7, 24 * 9, paid, sale="C"),  # paid too late
            event(8, 3, made, sale="D", plat="PC", total=7.5), event(9, 4, paid, sale="D"), event(10, 4, paid, sale="E")]
    deliver(spark, topic, rows)
    deliver(spark, topic, [event(50 + i, 24 * 400, k, sale=f"beat{i}") for i, k in enumerate((made, paid, gone))])
    st.run_for(lifecycle.start_life_cycle(stream(spark, topic), out, ckpt), 200)
    settled = spark.read.parquet(out)
    assert sorted(r.venta_id for r in settled.select("venta_id").distinct().collect()) == ["A", "B", "C", "D"]
    got = {r.plataforma: tuple(r)[1:] for r in lifecycle.net_revenue(settled).collect()}
    assert got == {"PS5": (3, 2, 1, 1, 10.0), "PC": (1, 1, 0, 0, 7.5)}


def brute(intervals, key, t):
    held = [(a, v) for k, v, a, z in intervals if k == key and k is not None and a <= t and (z is None or t < z)]
    return max(held)[1] if held else None


@pytest.mark.parametrize("bucket_days", [1, 5])
def test_as_of_join_with_overlaps_open_intervals_and_a_hot_key(spark, bucket_days):
    rng = random.Random(4)
    at = lambda d: DAY + dt.timedelta(days=d)
    intervals = [(f"C{i % 6}", f"v{i}", at(s := rng.randrange(-30, 40)), None if rng.random() < 0.3 else at(s + rng.randrange(0, 25))) for i in range(40)]
    facts = [(i, "C1" if i % 3 == 0 else f"C{rng.randrange(8)}", at(rng.randrange(0, 30)) + dt.timedelta(hours=rng.randrange(24))) for i in range(400)]
    facts += [(900, None, at(3)), (901, "C1", None), (900, None, at(3))]
    one = asof.disjoint(spark.createDataFrame(intervals, "cliente string, nivel string, desde timestamp, hasta timestamp"), "cliente")
    got = asof.as_of_join(spark.createDataFrame(facts, "n int, cliente string, t timestamp"), one, "cliente", "t", bucket_days)
    key = lambda r: (r[0], str(r))
    want = [(n, k, t, brute(intervals, k, t) if t else None) for n, k, t in facts]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    # the join deals facts by key and day, so the hot key's rows are spread
    assert "_d#" in got._jdf.queryExecution().executedPlan().toString()


def test_versions_open_only_on_change(spark):
    at = lambda d: DAY + dt.timedelta(days=d)
    rows = [("A", at(0), "x", 1), ("A", at(1), "x", 1), ("A", at(2), "y", 1), ("A", at(2), "w", 1), ("A", at(5), None, 1), ("B", at(1), None, None), (None, at(1), "z", 1), ("C", None, "z", 1)]
    got = asof.versions(spark.createDataFrame(rows, "k string, t timestamp, a string, b int"), "k", "t", ["a", "b"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("A", "x", 1, at(0), at(2)), ("A", "y", 1, at(2), at(5)), ("A", None, 1, at(5), None), ("B", None, None, at(1), None)], key=str)
    none = spark.createDataFrame([], "n int, k string, t timestamp")
    assert asof.as_of_join(none, got, "k", "t").count() == 0 and asof.as_of_join(none, got, "k", "t").columns == ["n", "k", "t", "a", "b"]


def test_a_delivery_is_one_batch_whatever_its_files(spark, tmp, monkeypatch):
    monkeypatch.setattr(jobs, "FILE_MESSAGES", 10)
    rows = spark.createDataFrame([(*event(i, i)[:2], None, 0 if i < 35 else 2) for i in range(40)], "key string, value string, timestamp timestamp, d int")
    read = []

    def start(batches):
        def note(batch, batch_id):
            read.append((batch_id, batch.count(), len({r[0] for r in batch.select(F.input_file_name()).distinct().collect()})))
        return batches.writeStream.foreachBatch(note).option("checkpointLocation", f"{tmp}/ckpt").trigger(availableNow=True).start()

    jobs.run_deliveries(spark, rows.coalesce(1), F.col("d"), 3, start)
    assert read == [(0, 35, 4), (1, 0, 0), (2, 5, 1)]


def test_windows_keep_one_narrow_row_per_event(spark, tmp):
    held = []
    plan = windows.windowed

    def watch(events, length, slide):
        held.append((events.columns, events.storageLevel.useMemory))
        return plan(events, length, slide)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(windows, "windowed", watch)
        windows.window_writer(tmp, "r", "7 days", "1 day", "1 day")(st.parse_events(spark.createDataFrame([event(1, 0), event(2, 1)], MESSAGE)), 0)
    assert held == [(["event_id", "event_timestamp", "plataforma", "total", "venta_riesgosa"], True)]
