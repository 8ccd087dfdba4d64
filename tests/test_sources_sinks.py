"""Sources and sinks round trips in temp folders."""

import os

from pyspark.sql import functions as F

from shopflow.schemas import CATALOG, CORRUPT, CUSTOMERS, INVENTORY_XML, MESSAGE
from shopflow.sinks import files as sinks
from shopflow.sources import files as sources


def test_csv_bom_fixed_schema_and_corrupt(spark, tmp):
    p = os.path.join(tmp, "clientes.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("cliente_id,nombre,edad,genero,distrito,nivel_membresia\n")
        f.write("C1,Ana Pérez,30,F, Miraflores ,Básico \n")
        f.write("C2,Bo,abc,M,Lima,Gold\n")
        f.write("C3,,41,M,Lima,Silver\n")
    df = sources.read_csv(spark, p, CUSTOMERS)
    got = {r.cliente_id: r for r in df.collect()}
    assert got["C1"].nombre == "Ana Pérez" and got["C1"].edad == 30
    assert got["C1"].distrito == " Miraflores " and got["C1"].nivel_membresia == "Básico "
    assert got["C2"].edad is None and got["C2"][CORRUPT] == "C2,Bo,abc,M,Lima,Gold"
    assert got["C3"].nombre is None and got["C3"][CORRUPT] is None


def test_csv_write_keeps_blanks_and_single_file(spark, tmp):
    df = spark.createDataFrame([("C1", " x ", None)], "a string, b string, c string")
    out = os.path.join(tmp, "out")
    sinks.write_csv(df.repartition(3), out, single=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    back = sources.read_csv_dir(spark, out, df.schema).first()
    assert tuple(back) == ("C1", " x ", None)


def test_json_array_multiline_and_lines(spark, tmp):
    arr = os.path.join(tmp, "cat")
    os.makedirs(arr)
    with open(os.path.join(arr, "catalogo.json"), "w") as f:
        f.write('[\n {"juego_id": "JV1", "titulo": "A", "plataformas": ["PS5", "PC"],\n'
                '  "precio_base": 10.5, "anio_lanzamiento": 2020, "pegi": 12, "tags": ["x"]},\n'
                ' {"juego_id": "JV2", "titulo": "B", "plataformas": [], "precio_base": "caro"}\n]\n')
    df = sources.read_json(spark, arr, CATALOG, multiline=True)
    got = {r.juego_id: r for r in df.collect()}
    assert got["JV1"].plataformas == ["PS5", "PC"] and got["JV1"].pegi == 12
    assert got["JV2"].precio_base is None
    lines = os.path.join(tmp, "lines")
    df.drop(CORRUPT).write.json(lines)
    back = sources.read_json(spark, lines, CATALOG, multiline=False)
    got = back.select("juego_id", CORRUPT).collect()
    assert len(got) == 2 and all(r[CORRUPT] is None for r in got)


def test_text_lines(spark, tmp):
    p = os.path.join(tmp, "log.txt")
    with open(p, "w") as f:
        f.write("a b c\n\nd e f\n")
    assert [r.value for r in sources.read_lines(spark, p).collect()] == ["a b c", "", "d e f"]


def test_xml_nested_one_row_per_platform(spark, tmp):
    p = os.path.join(tmp, "inv")
    os.makedirs(p)
    with open(os.path.join(p, "inventario.xml"), "w") as f:
        f.write('<inventario>\n'
                '<juego id="JV1"><titulo>A &amp; B</titulo><plataformas>'
                '<plataforma nombre="PS5"><stock>5</stock><precio>10.5</precio><umbral_reposicion>5</umbral_reposicion></plataforma>'
                '<plataforma nombre="Xbox"><stock>6</stock><precio>11.0</precio><umbral_reposicion>5</umbral_reposicion></plataforma>'
                '</plataformas></juego>\n'
                '<juego id="JV2"><titulo>Solo</titulo><plataformas>'
                '<plataforma nombre="Switch"><stock>1</stock><precio>3.0</precio><umbral_reposicion>2</umbral_reposicion></plataforma>'
                '</plataformas></juego>\n'
                '<juego id="JV3"><titulo>Nada</titulo><plataformas></plataformas></juego>\n'
                '</inventario>\n')
    cols = {"juego_id": "_id", "titulo_inv": "titulo", "plataforma": "item._nombre",
            "stock": "item.stock", "precio_inv": "item.precio", "umbral": "item.umbral_reposicion"}
    df = sources.read_xml_nested(spark, p, "juego", INVENTORY_XML, "plataformas.plataforma", cols)
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("JV1", "A & B", "PS5", 5, 10.5, 5), ("JV1", "A & B", "Xbox", 6, 11.0, 5),
                   ("JV2", "Solo", "Switch", 1, 3.0, 2)]
    outer = sources.read_xml_nested(spark, p, "juego", INVENTORY_XML, "plataformas.plataforma", cols, outer=True)
    assert outer.count() == 4


def test_xml_writer_round_trip(spark, tmp):
    df = spark.createDataFrame(
        [("JV1", "A <b>", {"plataforma": [("PS5", 1, 2.5, 3)]})],
        "_id string, titulo string, plataformas struct<plataforma: array<struct<_nombre:string, stock:int, precio:double, umbral_reposicion:int>>>")
    out = os.path.join(tmp, "x")
    sinks.write_xml(df, out, "juego", "inventario")
    back = spark.read.format("xml").option("rowTag", "juego").schema(INVENTORY_XML).load(out).first()
    assert back._id == "JV1" and back.titulo == "A <b>" and back.plataformas.plataforma[0]._nombre == "PS5"


def test_parquet_partitioned_prunes(spark, tmp):
    df = spark.createDataFrame([(2024, 1, 1.0), (2024, 2, 2.0), (None, None, 3.0)], "anio int, mes int, v double")
    out = os.path.join(tmp, "pq")
    sinks.write_parquet(df, out, ["anio", "mes"])
    sinks.write_parquet(df, out, ["anio", "mes"])  # overwrite is idempotent
    back = sources.read_parquet(spark, out)
    assert back.count() == 3 and back.filter(F.col("anio").isNull()).count() == 1
    plan = back.filter(F.col("mes") == 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mes" in plan


def test_encode_messages_round_trip(spark):
    df = spark.createDataFrame([("V1", 2.5, None, 3)], "venta_id string, total double, x string, n int")
    m = sinks.encode_messages(df, "venta_id", exclude=["n"])
    r = m.first()
    assert r.key == "V1" and r.value == '{"venta_id":"V1","total":2.5}' and r.n == 3


def test_read_stream_file_source(spark, tmp):
    p = os.path.join(tmp, "topic")
    spark.createDataFrame([("k", '{"a":1}', None)], MESSAGE).write.parquet(p)
    s = sources.read_stream(spark, "parquet", path=p)
    assert s.isStreaming and s.columns == ["key", "value", "timestamp"]


def test_plain_numbers_in_csv(spark, tmp):
    df = spark.createDataFrame([(18667993.8, 0.5, 12.0, None, "x")], "a double, b double, c double, d double, s string")
    r = sinks.plain_numbers(df).first()
    assert (r.a, r.b, r.c, r.d, r.s) == ("18667993.8", "0.5", "12", None, "x")
    out = os.path.join(tmp, "csv")
    sinks.write_csv(df, out, single=True, plain=True)
    text = open(os.path.join(out, [f for f in os.listdir(out) if f.startswith("part-")][0])).read()
    assert "18667993.8,0.5,12,,x" in text and "E7" not in text


def test_broken_xml_records_are_found_without_reading_their_text(spark, tmp):
    p = os.path.join(tmp, "inventario.xml")
    one = '<juego id="%s"><titulo>T</titulo><plataformas><plataforma nombre="PS5"><stock>%s</stock></plataforma></plataformas></juego>'
    rows = [one % ("J1", 3), one % ("J2", "tres"), one % ("J2", "tres"), one % ("J3", 4), one % ("J3", 4)]
    with open(p, "w") as f:
        f.write("<inventario>\n" + "\n".join(rows) + "\n</inventario>\n")
    broken = sources.rejected_xml(spark, p, "juego", INVENTORY_XML)
    assert [(r._id, r.titulo) for r in broken.collect()] == [("J2", "T"), ("J2", "T")]
    good = sources.read_xml_nested(spark, p, "juego", INVENTORY_XML, "plataformas.plataforma", {"juego_id": "_id", "stock": "item.stock"})
    assert sorted(map(tuple, good.collect())) == [("J1", 3), ("J3", 4), ("J3", 4)]
    for df in (broken, good):  # the reader finds a broken record's text by reading the file again up to it
        assert "_corrupt_record" not in df._jdf.queryExecution().executedPlan().toString()


def test_a_task_writes_xml_in_files_of_bounded_size(spark, tmp, monkeypatch):
    monkeypatch.setattr(sinks, "XML_RECORDS", 10)
    sinks.write_xml(spark.range(35).coalesce(1), tmp + "/x", "r", "rs")
    assert len([f for f in os.listdir(tmp + "/x") if f.startswith("part-")]) == 4
    assert spark.read.format("xml").option("rowTag", "r").schema("id long").load(tmp + "/x").distinct().count() == 35


def test_documents_are_compressed_files_of_bounded_size(spark, tmp, monkeypatch):
    monkeypatch.setattr(sinks, "DOCUMENTS", 10)
    sinks.write_documents(spark.range(35).coalesce(1), tmp, "c")
    parts = [f for f in os.listdir(tmp + "/c") if f.startswith("part-")]
    assert len(parts) == 4 and all(f.endswith(".json.gz") for f in parts)
    assert sinks.output_inventory(spark, tmp, ["c"]).first().documentos == 35
