"""The batch job over the shop's raw files (CSV, JSON arrays, text, XML)."""

import os

from pyspark.sql import functions as F

from shopflow.plans import jobs
from shopflow.plans.context import RawFiles

VENTAS = """venta_id,fecha,cliente_id,juego_id,plataforma,precio,cantidad,metodo_pago,vendedor
V1,2024-01-05,C1, jv001 ,PS5,100.0,2,Yape,S1
V1,2024-01-05,C1,JV001,PS5,100.0,2,Yape,S1
V2,2024-01-20,C2,JV002,Xbox Series X,50.5,1,Plin,S2
V3,2024-02-03,c1,JV001,PlayStation 4,80.0,1,Efectivo,S1
V4,2024-02-10,C3,JV003,Nintendo Switch,0,1,Yape,S3
V5,fecha-mala,C9,JV002,xbox,50.5,3,Yape,S2
V6,2024-02-11,C2,JV999,PC,10.0,1,Plin,S1
"""
CLIENTES = """cliente_id,nombre,edad,genero,distrito,nivel_membresia
C1,Ana,30,F, Miraflores ,Gold 
C2,Beto,25,M,Surco,Silver
C3,,40,M,Lima,Básico
"""
CATALOGO = """[
 {"juego_id": "JV001", "titulo": "Juego Uno", "categoria": "RPG", "plataformas": ["PlayStation 5", "PC"],
  "precio_base": 100.0, "desarrollador": "D1", "publicador": "P1", "anio_lanzamiento": 2022, "pegi": 18,
  "descripcion": "uno", "tags": ["a", "b"]},
 {"juego_id": "JV002", "titulo": "Juego Dos", "categoria": "Acción", "plataformas": ["Xbox Series X", "Xbox One"],
  "precio_base": 50.5, "desarrollador": "D2", "publicador": "P2", "anio_lanzamiento": 2023, "pegi": 12,
  "descripcion": "dos", "tags": []},
 {"juego_id": "JV003", "titulo": "Juego Tres", "categoria": "Aventura", "plataformas": ["Nintendo Switch"],
  "precio_base": 60.0, "desarrollador": "D3", "publicador": "P3", "anio_lanzamiento": 2021, "pegi": 7,
  "descripcion": "tres", "tags": ["c"]}
]
"""
RESENAS = """[
 {"resena_id": "R1", "juego_id": "JV001", "puntuacion": 4.5, "util_votos": 3, "comentario": "bien"},
 {"resena_id": "R2", "juego_id": "jv001", "puntuacion": 4.0, "util_votos": 1},
 {"resena_id": "R3", "juego_id": "JV002", "puntuacion": 3.0, "util_votos": 0}
]
"""
LOGS = """2024-01-05 10:00:00 INFO C1 LOGIN
2024-01-05 10:01:00 INFO C1 PURCHASE JV001
2024-01-05 10:02:00 WARN SISTEMA PURCHASE retry
2024-01-06 11:00:00 INFO C2 LOGIN
"""
INVENTARIO = """<inventario>
<juego id="JV001"><titulo>Juego Uno</titulo><plataformas>
 <plataforma nombre="PS5"><stock>3</stock><precio>100.0</precio><umbral_reposicion>5</umbral_reposicion></plataforma>
 <plataforma nombre="PC"><stock>20</stock><precio>90.0</precio><umbral_reposicion>5</umbral_reposicion></plataforma>
</plataformas></juego>
<juego id="JV002"><titulo>Juego Dos</titulo><plataformas>
 <plataforma nombre="Xbox"><stock>5</stock><precio>50.5</precio><umbral_reposicion>5</umbral_reposicion></plataforma>
</plataformas></juego>
</inventario>
"""


def write_raw(root):
    files = {"ventas.csv": (VENTAS, "utf-8"), "clientes.csv": (CLIENTES, "utf-8-sig"),
             "catalogo_juegos.json": (CATALOGO, "utf-8"), "resenas.json": (RESENAS, "utf-8"),
             "logs_tienda.txt": (LOGS, "utf-8"), "inventario.xml": (INVENTARIO, "utf-8")}
    for name, (text, enc) in files.items():
        with open(os.path.join(root, name), "w", encoding=enc) as f:
            f.write(text)


def test_batch_job_over_raw_files(spark, tmp):
    raw = os.path.join(tmp, "raw")
    os.makedirs(raw)
    write_raw(raw)
    r = RawFiles(spark, raw)
    out = jobs.run_batch(spark, r, os.path.join(tmp, "out"))

    wide = {x.venta_id: x for x in spark.read.parquet(out["ventas_enriquecidas"]).collect()}
    assert sorted(wide) == ["V1", "V2", "V3", "V5", "V6"]
    assert wide["V1"].titulo == "Juego Uno" and wide["V1"].nombre == "Ana" and wide["V1"].distrito == "Miraflores"
    assert wide["V1"].puntuacion_promedio == 4.25 and wide["V1"].total_resenas == 2
    assert wide["V1"].compras_en_log == 1 and wide["V1"].sesiones_log == 1
    assert wide["V3"].titulo is None and wide["V3"].plataforma == "PS4" and wide["V3"].nombre == "Ana"
    assert wide["V5"].fecha is None and wide["V5"].titulo == "Juego Dos" and wide["V5"].nombre is None

    plat = {x.plataforma: x for x in spark.read.option("header", True).option("inferSchema", True)
            .csv(out["plataformas"]).collect()}
    assert {p: (x.num_ventas, x.stock_actual) for p, x in plat.items()} == {
        "PS5": (1, 3), "XBOX": (2, 5), "PS4": (1, 0), "PC": (1, 20)}
    assert plat["XBOX"].ingresos_total == 202.0

    top = [x.juego_id for x in spark.read.option("header", True).csv(out["top_juegos"]).collect()]
    assert top == ["JV002", "JV001"]
    low = sorted((x.juego_id, x.plataforma) for x in spark.read.json(out["alertas_inventario"]).collect())
    assert low == [("JV001", "PS5"), ("JV002", "XBOX")]

    meta = spark.read.json(out["pipeline_metadata"]).first()
    assert {f.archivo: f.registros for f in meta.fuentes} == {
        "ventas.csv": 7, "clientes.csv": 3, "catalogo_juegos.json": 3, "resenas.json": 3,
        "logs_tienda.txt": 4, "inventario.xml": 3}
    assert r.rejected_rows.count() == 0


def test_rejected_raw_rows(spark, tmp):
    raw = os.path.join(tmp, "raw")
    os.makedirs(raw)
    write_raw(raw)
    with open(os.path.join(raw, "ventas.csv"), "a") as f:
        f.write("V7,2024-03-01,C1,JV001,PS5,caro,1,Yape,S1\n")
    r = RawFiles(spark, raw)
    rej = r.rejected_rows.collect()
    assert [(x.archivo, x.clave, x.registro) for x in rej] == [
        ("ventas.csv", "V7", "V7,2024-03-01,C1,JV001,PS5,caro,1,Yape,S1")]
    assert r.sales.filter(F.col("venta_id") == "V7").count() == 0  # NULL price is dropped by the cleanse


def test_raw_inputs_as_many_files_and_json_lines(spark, tmp):
    import json

    raw = os.path.join(tmp, "raw")
    os.makedirs(os.path.join(raw, "ventas"))
    write_raw(raw)
    header, *lines = VENTAS.strip().split("\n")
    for i in range(3):  # the sales split over three files, each with its header
        with open(os.path.join(raw, "ventas", f"part-{i}.csv"), "w") as f:
            f.write("\n".join([header, *lines[i::3]]) + "\n")
    for name, text in (("catalogo_juegos.jsonl", CATALOGO), ("resenas.jsonl", RESENAS)):
        with open(os.path.join(raw, name), "w") as f:
            f.write("\n".join(json.dumps(x) for x in json.loads(text)) + "\n")
    r = RawFiles(spark, raw, names={"sales": "ventas", "catalog": "catalogo_juegos.jsonl",
                                    "reviews": "resenas.jsonl"}, json_lines=True)
    assert r.raw_sales.count() == 7
    assert sorted(x.venta_id for x in r.sales.collect()) == ["V1", "V2", "V3", "V5", "V6"]
    assert {x.juego_id: x.puntuacion_promedio for x in r.scores.collect()} == {"JV001": 4.25, "JV002": 3.0}
    assert r.catalog.count() == 4  # JV001: PS5, PC; JV002: XBOX (two spellings); JV003: SWITCH
