"""T-S1..T-S9, K7-K9, F6, J7: decode, enrich, summarise, idempotent sinks."""

import os

from pyspark.sql import functions as F

from shopflow.schemas import CORRUPT, MESSAGE
from shopflow.sinks import files as sinks
from shopflow.streaming import events as st

GOOD = ('{"event_id":"EVT-%06d","event_type":"venta_creada","event_timestamp":"2024-01-05T10:00:0%d",'
        '"venta_id":"V%d","cliente_id":"C%d","plataforma":"%s","metodo_pago":"Yape","precio":10.0,'
        '"cantidad":2,"total":20.0,"riesgo_fraude":%s,"venta_riesgosa":%s}')


def msg(i, plat="Xbox", risk="0.5", flag="false", cust=1):
    return (f"V{i}", GOOD % (i, i % 10, i, cust, plat, risk, flag), None)


def messages(spark, rows):
    return spark.createDataFrame(rows, MESSAGE)


def test_decode_splits_rejects(spark):
    raw = messages(spark, [msg(1), ("V2", '{"event_id":"EVT-2", broken', None),
                           ("V3", (GOOD % (3, 3, 3, 1, "PS5", "0.9", "true")).replace('"cantidad":2', '"cantidad":"dos"'), None),
                           ("V4", None, None)])
    valid, rejects = st.decode_events(raw)
    v = valid.collect()
    assert [r.event_id for r in v] == ["EVT-000001"]
    assert v[0].plataforma == "XBOX" and str(v[0].event_timestamp) == "2024-01-05 10:00:01"
    assert sorted(r.message_key for r in rejects.collect()) == ["V2", "V3", "V4"]
    assert CORRUPT not in valid.columns


def test_enrich_defaults(spark):
    ev = spark.createDataFrame([(" c1", None, None, None), ("C9", None, None, None), ("C2", "Zoe", None, None)],
                               "cliente_id string, cliente_nombre string, nivel_membresia string, distrito string")
    dim = spark.createDataFrame([("C1", "Ana", "Gold", "Lima"), ("C2", "Bea", None, "Cusco")],
                                "cliente_id string, nombre string, nivel_membresia string, distrito string")
    got = {r.cliente_id: tuple(r)[1:] for r in st.enrich_events(ev, dim).collect()}
    assert got == {" c1": ("Ana", "Gold", "Lima"), "C9": ("desconocido", "Normal", "Desconocido"),
                   "C2": ("Zoe", "Normal", "Cusco")}


def test_handlers_summary_shapes(spark):
    raw = messages(spark, [msg(1, "PS5", "0.8", "true"), msg(2, "PS5", "0.1", "false"),
                           msg(3, "Xbox", "0.75", "null"), msg(4, "Xbox", "0.2", "null")])
    valid, _ = st.decode_events(raw)
    plat = {r.plataforma: r for r in st.stream_by_platform(valid).collect()}
    assert (plat["PS5"].total_ventas, plat["PS5"].ingresos, plat["PS5"].ventas_riesgo) == (2, 40.0, 1)
    assert plat["XBOX"].ventas_riesgo is None
    pay = st.stream_by_payment(valid).first()
    assert pay.total_transacciones == 4 and pay.riesgo_promedio == 0.46
    assert sorted(r.event_id for r in st.alerts(valid).collect()) == ["EVT-000001", "EVT-000003"]


def _write_topic(spark, path, batches):
    for i, rows in enumerate(batches):
        messages(spark, rows).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp):
    topic, out, ck = (os.path.join(tmp, x) for x in ("topic", "out", "ck"))
    batches = [[msg(i, "PS5" if i % 2 else "PC", "0.9" if i % 3 == 0 else "0.1") for i in range(b * 10, b * 10 + 10)]
               for b in range(3)]
    batches[1].append(("VX", "not json", None))
    _write_topic(spark, topic, batches)
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(topic)
    q = st.start_batches(stream, out, ck, run_id="t1")
    q.awaitTermination()
    assert q.exception() is None
    by_batch = spark.read.parquet(f"{out}/summary_by_platform")
    assert sorted(r.batch_id for r in by_batch.select("batch_id").distinct().collect()) == [0, 1, 2]
    assert by_batch.agg(F.sum("total_ventas")).first()[0] == 30
    # the whole stream equals the batch handler over all messages
    valid, _ = st.decode_events(messages(spark, [m for b in batches for m in b]))
    assert spark.read.parquet(f"{out}/alerts").count() == st.alerts(valid).count() == 10
    assert [r.message_key for r in spark.read.parquet(f"{out}/rejects").collect()] == ["VX"]
    # replaying batch 1 rewrites its folder instead of appending
    write = st.batch_writer(out, {"summary_by_platform": st.stream_by_platform}, "t1")
    valid1, _ = st.decode_events(messages(spark, batches[1]))
    write(valid1, 1)
    write(valid1, 1)
    again = spark.read.parquet(f"{out}/summary_by_platform")
    assert again.agg(F.sum("total_ventas")).first()[0] == 30
    # a restarted query with the same checkpoint finds nothing new
    q2 = st.start_batches(spark.readStream.schema(MESSAGE).parquet(topic), out, ck, run_id="t1")
    q2.awaitTermination()
    assert spark.read.parquet(f"{out}/summary_by_platform").agg(F.sum("total_ventas")).first()[0] == 30


def test_empty_batch_writes_nothing(spark, tmp):
    write = st.batch_writer(tmp, {"x": lambda b: b}, "r")
    write(spark.createDataFrame([], "a int"), 0)
    assert not os.path.exists(os.path.join(tmp, "x"))


def test_encode_then_decode(spark):
    ev = spark.createDataFrame([("V1", "EVT-000001", "PS5", 0.5, True)],
                               "venta_id string, event_id string, plataforma string, riesgo_fraude double, venta_riesgosa boolean")
    raw = sinks.encode_messages(ev, "venta_id").withColumn("timestamp", F.current_timestamp())
    valid, rejects = st.decode_events(raw)
    r = valid.first()
    assert r.message_key == "V1" and r.event_id == "EVT-000001" and r.venta_riesgosa is True
    assert rejects.count() == 0


def test_dedupe_within_watermark_and_bounded_run(spark, tmp):
    topic, out, ck = (os.path.join(tmp, x) for x in ("topic", "out", "ck"))
    rows = [msg(1), msg(2), msg(1), msg(3)]  # event 1 delivered twice
    _write_topic(spark, topic, [rows])
    stream = spark.readStream.schema(MESSAGE).parquet(topic)
    q = st.start_batches(stream, out, ck, run_id="d", dedupe_within="10 minutes")
    st.run_for(q, 120)
    ev = spark.read.parquet(f"{out}/events")
    assert sorted(r.event_id for r in ev.collect()) == ["EVT-000001", "EVT-000002", "EVT-000003"]


def test_dedupe_keeps_every_reject(spark, tmp):
    topic, out, ck = (os.path.join(tmp, x) for x in ("topic", "out", "ck"))
    _write_topic(spark, topic, [[msg(1), msg(1), *[(f"B{i}", "broken", None) for i in range(3)], ("B0", "broken", None), ("B9", None, None)]])
    stream = spark.readStream.schema(MESSAGE).parquet(topic)
    st.run_for(st.start_batches(stream, out, ck, run_id="r", dedupe_within="10 minutes"), 120)
    assert spark.read.parquet(f"{out}/rejects").count() == 5
    assert spark.read.parquet(f"{out}/events").count() == 1


def test_processing_time_trigger_is_stopped(spark, tmp):
    topic, out, ck = (os.path.join(tmp, x) for x in ("topic", "out", "ck"))
    _write_topic(spark, topic, [[msg(1), msg(2)]])
    stream = spark.readStream.schema(MESSAGE).parquet(topic)
    q = st.run_for(st.start_batches(stream, out, ck, run_id="p", trigger={"processingTime": "1 second"}), 15)
    assert not q.isActive and spark.read.parquet(f"{out}/events").count() == 2


def test_summaries_and_alerts_are_ordered(spark):
    raw = messages(spark, [msg(1, "PS5", "0.8"), msg(2, "PS5", "0.9"), msg(3, "PC", "0.95"), msg(4, "Xbox", "0.1"), msg(5, "Xbox", "0.76")])
    valid, _ = st.decode_events(raw.repartition(3))
    assert [r.event_id for r in st.alerts(valid).collect()] == ["EVT-000003", "EVT-000002", "EVT-000001", "EVT-000005"]
    assert [r.plataforma for r in st.stream_by_platform(valid).collect()] == ["PS5", "XBOX", "PC"]


def test_summary_event_type_filter(spark):
    raw = messages(spark, [msg(1), msg(2)])
    valid, _ = st.decode_events(raw)
    assert st.stream_by_platform(valid, ["venta_creada"]).first().total_ventas == 2
    assert st.stream_by_platform(valid, ["venta_cancelada"]).count() == 0


def test_alerts_per_batch_equal_risky_sum_when_flag_matches_risk(spark, tmp):
    topic, out, ck = (os.path.join(tmp, x) for x in ("topic", "out", "ck"))
    risks = [0.1, 0.74, 0.75, 0.76, 0.9, 0.3]
    batches = [[msg(b * 10 + i, "PS5" if i % 2 else "PC", str(r), "true" if r >= 0.75 else "false")
                for i, r in enumerate(risks)] for b in range(2)]
    _write_topic(spark, topic, batches)
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(topic)
    st.run_for(st.start_batches(stream, out, ck, run_id="inv"), 120)
    alerts = {r.batch_id: r.n for r in spark.read.parquet(f"{out}/alerts").groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    risky = {r.batch_id: r.n for r in spark.read.parquet(f"{out}/summary_by_platform").groupBy("batch_id").agg(F.sum("ventas_riesgo").alias("n")).collect()}
    assert alerts == risky == {0: 3, 1: 3}
