"""End-to-end batch and stream jobs at sf0.001."""

import os

from pyspark.sql import functions as F

from shopflow.plans import jobs

from .conftest import SF001


def test_run_batch_outputs(spark, tmp):
    out = jobs.run_batch(spark, SF001, os.path.join(tmp, "batch"))
    wide = spark.read.parquet(out["ventas_enriquecidas"])
    assert wide.count() > 0 and {"anio", "mes"} <= set(wide.columns)
    top = spark.read.option("header", True).csv(out["top_juegos"])
    assert top.count() == 10 and len([f for f in os.listdir(out["top_juegos"]) if f.startswith("part-")]) == 1
    meta = spark.read.json(out["pipeline_metadata"]).first()
    assert meta.ventas_procesadas == wide.count()
    docs = {x.coleccion: x.documentos for x in meta.documentos_por_coleccion}
    assert docs["ventas_procesadas"] == wide.count()
    assert docs["alertas_inventario"] == spark.read.json(out["alertas_inventario"]).count()
    counts = {f.archivo: f.registros for f in meta.fuentes}
    assert counts["ventas.csv"] == spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert spark.read.json(out["ventas_procesadas"]).count() == wide.count()
    from shopflow.plans.tables import COLLECTIONS

    assert len(COLLECTIONS) == 7 and set(COLLECTIONS) <= set(docs)
    assert docs["analisis_juegos"] == docs["perfil_clientes"] == 10
    profile = spark.read.json(out["perfil_productos"])
    assert profile.select("metricas.total_ventas_unidades").agg(F.sum("total_ventas_unidades")).first()[0] \
        == wide.agg(F.sum("cantidad")).first()[0]


def test_run_stream_job(spark, tmp):
    root = os.path.join(tmp, "stream")
    jobs.run_stream(spark, SF001, root, os.path.join(tmp, "ck"), run_id="j1", seconds=300)
    ev = spark.read.parquet(f"{root}/stream/events")
    rej = spark.read.parquet(f"{root}/stream/rejects")
    n = spark.read.parquet(f"{SF001}/events.parquet").count()
    assert ev.count() + rej.count() == n
    summ = spark.read.parquet(f"{root}/stream/summary_by_platform")
    assert summ.agg(F.sum("total_ventas")).first()[0] == ev.count()


def test_run_stream_with_bucketed_dimension(spark, tmp):
    root = os.path.join(tmp, "stream")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        jobs.run_stream(spark, SF001, root, os.path.join(tmp, "ck"), run_id="b1", seconds=300,
                        dim_buckets=4)
        dim = spark.table("dim_clientes_b1")
        batch = spark.read.parquet(f"{root}/stream/events").select("cliente_id").distinct()
        plan = batch.join(dim, "cliente_id", "left")._jdf.queryExecution().executedPlan().toString()
        # one exchange (the distinct on the batch side); none above the bucketed dimension scan
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        if old_aqe is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old_aqe)
    ev = spark.read.parquet(f"{root}/stream/events")
    known = ev.filter(ev.cliente_nombre != "desconocido").count()
    assert ev.count() > 0 and known > 0


def test_command_line(spark, tmp):
    from shopflow.__main__ import main

    out = main(["query", "--tables", SF001, "--name", "kpi_summary", "--out", os.path.join(tmp, "q")])
    assert spark.read.parquet(out["kpi_summary"]).count() == 1
    res = main(["batch", "--tables", SF001, "--out", os.path.join(tmp, "b")])
    assert spark.read.parquet(res["ventas_enriquecidas"]).count() > 0


def test_charts_from_exported_kpi_files(spark, tmp):
    from shopflow.operators import documents

    out = jobs.run_batch(spark, SF001, os.path.join(tmp, "b"))
    kpi_root = os.path.dirname(out["top_juegos"])
    from_files = sorted(tuple(r) for r in documents.charts_from_kpi_files(spark, kpi_root).collect())
    from_docs = sorted(tuple(r) for r in spark.read.json(out["series_graficos"]).select(
        "serie", "etiqueta", "valor", "texto").collect())
    assert from_files == from_docs and len(from_files) > 0


def test_sql_over_registered_views_and_kpi_cli(spark, tmp):
    from shopflow.__main__ import main
    from shopflow.operators import kpis

    out = jobs.run_batch(spark, SF001, os.path.join(tmp, "b"))
    jobs.register_views(spark, out["ventas_enriquecidas"], out["inventario"])
    row = spark.sql("""
        SELECT COUNT(venta_id) AS total_ventas, SUM(cantidad) AS unidades,
               COUNT(DISTINCT cliente_id) AS clientes, COUNT(DISTINCT juego_id) AS juegos
        FROM ventas""").first()
    s = kpis.kpi_summary(spark.read.parquet(out["ventas_enriquecidas"])).first()
    assert (row.total_ventas, row.unidades, row.clientes, row.juegos) == (
        s.total_ventas, s.total_unidades_vendidas, s.clientes_activos, s.juegos_vendidos)
    low = spark.sql("SELECT COUNT(*) AS n FROM inventario WHERE stock <= umbral").first().n
    assert low == spark.read.json(out["alertas_inventario"]).count()
    res = main(["kpis", "--wide", out["ventas_enriquecidas"], "--inventory", out["inventario"],
                "--out", os.path.join(tmp, "k")])
    assert spark.read.option("header", True).csv(res["top_juegos"]).count() == 10
    ch = main(["charts", "--kpis", os.path.join(tmp, "k"), "--out", os.path.join(tmp, "d")])
    assert spark.read.json(ch["series_graficos"]).count() > 10
