"""Clean sales and wide table in chunks: the same rows as in one job, and no shuffle file left behind by a step."""

import os
import time

import pytest
from pyspark.sql import functions as F

from shopflow.operators import cleanse
from shopflow.plans import jobs, staged, stored
from shopflow.plans.context import Retail
from shopflow.plans.queries import REGISTRY
from shopflow.plans.tables import COLLECTIONS
from shopflow.session import SHUFFLE_CLEANUP, work_path
from shopflow.sinks import files as sinks
from tests.conftest import SF001


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_by(spark, run):
    """The shuffle files that ``run`` leaves; Spark removes them in the background."""
    before = shuffle_files(spark)
    run()
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return set()
        time.sleep(0.1)
    return shuffle_files(spark) - before


def retail(spark, sales, salt=0):
    """A shop whose dimensions have a row, two rows, or none for a sale."""
    r = Retail(spark, "none", salt)
    r.raw_sales = spark.createDataFrame(sales, "venta_id string, fecha string, cliente_id string, juego_id string, plataforma string, "
                                               "precio double, cantidad int, metodo_pago string, vendedor string")
    r.raw_customers = spark.createDataFrame([("C1", "Ana", 30, "F", " Lima", "Oro "), ("C1", "Ana", 31, "F", "Lima", "Oro"), (None, "Sin", 1, "M", "x", "y")],
                                            "cliente_id string, nombre string, edad int, genero string, distrito string, nivel_membresia string")
    r.raw_catalog = spark.createDataFrame(
        [("P1", "Uno", "RPG", ["PS5", "PlayStation 5"], 9.5, "D", "Pub", 2001, 12, "d", ["a", "b"])],
        "juego_id string, titulo string, categoria string, plataformas array<string>, precio_base double, desarrollador string, publicador string, "
        "anio_lanzamiento int, pegi int, descripcion string, tags array<string>")
    r.raw_reviews = spark.createDataFrame([("R1", "P1", 4.0, 2), (None, "P9", None, None)], "resena_id string, juego_id string, puntuacion double, util_votos int")
    r.log_lines = spark.createDataFrame([("2024-01-01 10:00:00 INFO C1 PURCHASE P1",)], "value string")
    return r


def sales(n=300):
    """Sales of which every third comes twice, once with blanks around its id; some cannot be counted."""
    out = []
    for i in range(n):
        row = (f"V{i}", f"200{i % 3}-0{i % 9 + 1}-05" if i % 7 else "sin fecha", f"C{i % 3}" if i % 5 else None, f" p{i % 4} ", "ps5" if i % 2 else "xbox",
               10.0 + i % 6 if i % 11 else 0.0, i % 4, "Yape", "S1")
        out += [row] + ([(f" V{i} ", "2009-01-01", *row[2:])] if i % 3 == 0 else [])
    return out + [(None, "2001-01-01", "C1", "P1", "PS5", 5.0, 1, "Yape", "S1"), ("V1", None, "C1", "P1", "PS5", 1e17, 1, "Yape", "S1")]


def as_rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("salt", [0, 3])
def test_wide_table_in_chunks_has_the_rows_of_one_job(spark, monkeypatch, salt):
    r = retail(spark, sales(), salt)
    for chunk in (150, 10**6):
        monkeypatch.setattr(staged, "CHUNK", chunk)
        path = work_path(spark, "test")
        staged.write_wide(r, path)
        got = spark.read.parquet(path)
        assert got.schema == r.wide.schema and as_rows(got) == as_rows(r.wide)


def test_a_sale_is_in_one_chunk_and_a_chunk_goes_when_it_is_done(spark, monkeypatch):
    monkeypatch.setattr(staged, "CHUNK", 100)
    counts, root, r = [], None, retail(spark, sales())
    for i, part in enumerate(staged.chunks(r)):
        counts.append({x.venta_id for x in part.select("venta_id").collect()})
        root = root or part.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
        assert {f for f in os.listdir(root) if f.startswith("_chunk=")} == {f"_chunk={k}" for k in range(i, 4)}
    assert len(counts) == 4 and sum(map(len, counts)) == len(set().union(*counts)) == r.sales.count()


@pytest.mark.parametrize("rows", [[], [("V1", "2001-01-01", "C1", "P1", "PS5", 5.0, 1, "Yape", "S1")] * 9])
def test_no_sales_and_one_sale_only(spark, monkeypatch, rows):
    monkeypatch.setattr(staged, "CHUNK", 2)
    r, path = retail(spark, rows), work_path(spark, "test")
    staged.write_wide(r, path)
    assert as_rows(spark.read.parquet(path)) == as_rows(r.wide) and r.sales.count() == min(1, len(rows))


def test_a_write_removes_its_shuffle_files(spark, tmp):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    setting = spark.conf.get(SHUFFLE_CLEANUP)
    for i, write in enumerate((sinks.write_parquet, sinks.write_csv, lambda d, path: sinks.write_documents(d, tmp, "docs"))):
        assert not left_by(spark, lambda: write(df, f"{tmp}/{i}"))
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


@pytest.mark.parametrize("name", ["output_inventory", "kpi_order", "charts_from_csv", "parquet_roundtrip", "distinct_by_period"])
def test_steps_of_a_query_leave_no_shuffle_files(spark, monkeypatch, name):
    monkeypatch.setattr(staged, "CHUNK", 3000)
    assert not left_by(spark, lambda: REGISTRY[name](spark, SF001))


def test_the_document_of_every_sale_is_written_last(monkeypatch):
    order = []
    monkeypatch.setattr(sinks, "write_collections", lambda c, root: order.extend(c) or dict.fromkeys(c, 1))
    monkeypatch.setattr(jobs, "COLLECTIONS", {n: lambda f, n=n: n for n in COLLECTIONS})
    assert list(jobs.write_kpi_documents(None, "none", {"otra": None})) == [*COLLECTIONS, "otra"]
    assert order[-1] == "ventas_procesadas" and sorted(order) == sorted([*COLLECTIONS, "otra"])


def test_distinct_keys_of_periods_match_a_count_of_every_sale(spark):
    r = retail(spark, [*sales(), ("W1", "1990-12-31", None, None, "PS5", 5.0, 1, "Yape", "S1")])
    clean = r.sales.select("anio", "mes", "cliente_id", "juego_id")
    want = stored.periods(clean).groupBy("periodo").agg(F.count_distinct("cliente_id").alias("clientes"), F.count_distinct("juego_id").alias("juegos"))
    got = stored.distinct_keys(stored.months_of(clean, cliente_id="clientes", juego_id="juegos"), "clientes", "juegos")
    assert as_rows(got) == as_rows(want) and ("1990-12", 0, 0) in [tuple(x) for x in got.collect()]
    nothing = clean.filter("false")
    assert not stored.distinct_keys(stored.months_of(nothing, cliente_id="clientes"), "clientes").collect()


def test_rows_that_count_are_deduped_as_clean_sales_does(spark):
    raw = retail(spark, sales()).raw_sales
    assert as_rows(cleanse.latest_sales(cleanse.countable_sales(raw))) == as_rows(cleanse.clean_sales(raw))
