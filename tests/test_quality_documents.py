"""Q1-Q4, D1-D3, P11/P12, C1, R1, K4-K6."""

import datetime as dt

from pyspark.sql import functions as F

from shopflow.operators import documents, quality
from shopflow.sinks import files as sinks


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = sorted(tuple(r) for r in quality.null_profile(df).collect())
    assert got == [("a", 1, 3), ("b", 2, 3)]


def test_validate_split_and_reasons(spark):
    df = spark.createDataFrame([("G1", "T", "RPG", 10.0, 12), ("G2", None, "RPG", 0.0, 12),
                                ("G3", "T", None, None, 99)],
                               "juego_id string, titulo string, categoria string, precio_base double, pegi int")
    valid, rejected = quality.validate(df, quality.game_rules())
    assert [r.juego_id for r in valid.collect()] == ["G1"]
    rep = {r.juego_id: r for r in quality.validation_report(df, "juego_id").collect()}
    assert rep["G1"].valido and rep["G1"].motivos == ""
    assert rep["G2"].motivos == "falta titulo"
    assert rep["G3"].motivos == "falta categoria; falta precio_base"
    values = {r.juego_id: r.motivos for r in quality.validation_report(df, "juego_id", quality.value_rules()).collect()}
    assert values == {"G1": "", "G2": "precio_base no positivo", "G3": "pegi fuera de rango"}
    assert rejected.count() == 2


def test_document_report_types(spark):
    good = '"juego_id":"G","titulo":"T","categoria":"C","precio_base":9.5'
    docs = {"{" + good + "}": "", "{" + good + ',"pegi":null}': "tipo pegi", "{" + good + ',"pegi":"18"}': "tipo pegi", "{" + good + ',"pegi":18,"otro":1}': "",
            '{"juego_id":"G","categoria":null,"precio_base":"x"}': "falta titulo; tipo categoria; tipo precio_base",
            "no json": "no es un documento; falta juego_id; falta titulo; falta categoria; falta precio_base"}
    for text, want in docs.items():
        r = quality.document_report(spark.createDataFrame([(text,)], "value string")).first()
        assert (r.motivos, r.valido) == (want, not want), text


def test_duplicate_and_orphan_keys(spark):
    s = spark.createDataFrame([("V1", "C1"), ("V1", "C2"), ("V2", "C9"), ("V3", None)], "venta_id string, cliente_id string")
    c = spark.createDataFrame([("C1",), ("C2",)], "cliente_id string")
    assert [tuple(r) for r in quality.duplicate_keys(s, ["venta_id"]).collect()] == [("V1", 2)]
    got = sorted((tuple(r) for r in quality.orphan_keys(s, c, ["cliente_id"]).collect()), key=str)
    assert got == sorted([("C9", 1), (None, 1)], key=str)


def test_to_document_types_recursive(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), 1)], "d date, x int").select(
        "d", F.lit(1.5).cast("decimal(10,2)").alias("m"),
        F.struct(F.lit(2.25).cast("decimal(10,2)").alias("inner")).alias("s"),
        F.array(F.lit(1).cast("decimal(5,1)")).alias("a"))
    out = documents.to_document_types(df)
    types = dict(out.dtypes)
    assert types == {"d": "string", "m": "double", "s": "struct<inner:double>", "a": "array<double>"}
    r = out.first()
    assert r.d == "2024-01-02" and r.m == 1.5 and r.s.inner == 2.25


def test_documents_round_trip_and_inventory(spark, tmp):
    a = spark.createDataFrame([("PS5", 3, 41.0), ("PC", 1, 7.5)], "plataforma string, num_ventas long, ingresos_total double")
    b = spark.createDataFrame([(1, [1, 2], ("x", 2.5))], "k int, arr array<int>, s struct<n:string,v:double>")
    sinks.write_documents(a, tmp, "plataformas")
    sinks.write_documents(b, tmp, "anidado")
    sinks.write_documents(a, tmp, "plataformas")  # replace, not append
    back = documents.read_back(spark, tmp, "plataformas", ["plataforma", "num_ventas"], [F.desc("num_ventas")])
    assert [tuple(r) for r in back.collect()] == [("PS5", 3), ("PC", 1)]
    nested = spark.read.json(f"{tmp}/anidado").first()
    assert nested.arr == [1, 2] and nested.s.v == 2.5
    inv = sorted(tuple(r) for r in sinks.output_inventory(spark, tmp, ["plataformas", "anidado"]).collect())
    assert inv == [("anidado", 1), ("plataformas", 2)]


def test_run_metadata_counts_every_source(spark):
    srcs = {"a.csv": ("CSV", spark.range(5)), "b.json": ("JSON", spark.range(0)), "c.txt": ("TXT", spark.range(7))}
    meta = sinks.run_metadata(spark, srcs, ["x", "y"]).first()
    assert [(f.archivo, f.formato, f.registros) for f in meta.fuentes] == [
        ("a.csv", "CSV", 5), ("b.json", "JSON", 0), ("c.txt", "TXT", 7)]
    assert meta.colecciones_creadas == ["x", "y"] and meta.estado == "COMPLETADO"
    assert meta.tecnologias.procesamiento.startswith("Apache Spark")


def test_count_of_observation(spark):
    df, obs = sinks.count_of(spark.range(42), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["n"] == 42


def test_chart_series_labels(spark):
    df = spark.createDataFrame([("PS5", 1234567.49), ("PC", 0.5)], "p string, v double")
    got = sorted(tuple(r) for r in documents.chart_series(df, "plataformas", "p", "v").collect())
    assert got == [("plataformas", "PC", 0.5, "S/1"), ("plataformas", "PS5", 1234567.49, "S/1,234,567")]
