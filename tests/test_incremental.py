"""Deliveries applied one by one against a full rebuild from all of them."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from shopflow.operators import cleanse, integrate
from shopflow.plans import incremental as inc
from shopflow.schemas import SALES

CUSTOMERS = "cliente_id string, nombre string, edad int, genero string, distrito string, nivel_membresia string"
CATALOG = "juego_id string, plataforma string, titulo string, categoria string, desarrollador string, anio_lanzamiento int, tags array<string>"
SCORES = "juego_id string, puntuacion_promedio double, total_resenas long, total_votos_util long"
ACTIVITY = "cliente_id string, compras_en_log long, sesiones_log long"


def sale(i, day, customer="C1", game="P1", price=10.0, units=1, plat="PS5"):
    return (f"V{i}", day, customer, game, plat, price, units, "Yape", "S1")


def dims(spark, customers=(("C1", "Ana"), ("C2", "Bea")), titles=(("P1", "Uno"), ("P2", "Dos")), votes=1):
    return {
        "customers": spark.createDataFrame([(c, n, 30, "F", "Lima", "Gold") for c, n in customers], CUSTOMERS),
        "catalog": spark.createDataFrame([(g, "PS5", t, "RPG", "X", 2000, ["a"]) for g, t in titles], CATALOG),
        "scores": spark.createDataFrame([("P1", 4.0, 1, votes)], SCORES),
        "activity": spark.createDataFrame([("C1", 1, 2)], ACTIVITY),
    }


def files(table):
    return {os.path.relpath(p, table.path) for p in glob.glob(f"{table.path}/anio=*/mes=*/*.parquet")}


def rows(table):
    df = table.read()
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture()
def table(spark, tmp):
    return inc.WideTable(spark, f"{tmp}/inc")


def rebuilt(spark, tmp, deliveries, now):
    full = inc.WideTable(spark, f"{tmp}/full")
    full.rebuild(spark.createDataFrame([s for d in deliveries for s in d], SALES), now)
    return rows(full)


def test_random_deliveries_equal_a_rebuild_and_leave_other_months(spark, tmp, table):
    rng, deliveries = random.Random(5), []
    for n in (60, 12, 12):
        deliveries.append([sale(rng.randrange(70), rng.choice(["bad", *[str(dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(400))) for _ in range(9)]]),
                                rng.choice(["C1", "C2", "C9"]), rng.choice(["P1", "P2", "P9"]), rng.choice([5.0, 0.0, 12.5]), rng.randrange(1, 4)) for _ in range(n)])
    for i, d in enumerate(deliveries):
        now = dims(spark, titles=(("P1", "Uno"),) if i < 2 else (("P1", "Uno"), ("P2", "Dos")))
        before = files(table) if i else set()
        months = table.apply(spark.createDataFrame(d, SALES), now)
        folders = {inc._folder(m) for m in months}
        assert {f for f in before if os.path.dirname(f) not in folders} <= files(table)
        assert not {f for f in before if os.path.dirname(f) in folders} & files(table)
    assert rows(table) == rebuilt(spark, tmp, deliveries, now)


def test_a_moved_sale_empties_its_month_and_a_replay_writes_nothing(spark, tmp, table):
    first = [sale(1, "2024-01-05"), sale(2, "2024-02-05"), sale(3, "2024-03-05"), sale(3, "2024-03-05")]
    moved = [sale(1, "2024-02-10")]
    assert table.apply(spark.createDataFrame(first, SALES), dims(spark)) == [202401, 202402, 202403]
    assert table.apply(spark.createDataFrame(moved, SALES), dims(spark)) == [202401, 202402]
    assert {os.path.dirname(f) for f in files(table)} == {"anio=2024/mes=2", "anio=2024/mes=3"}
    before = files(table)
    assert table.apply(spark.createDataFrame(moved, SALES), dims(spark)) == []
    assert table.apply(spark.createDataFrame([], SALES), dims(spark)) == []
    assert files(table) == before and rows(table) == rebuilt(spark, tmp, [first, moved], dims(spark))


def test_a_late_older_version_loses_also_when_its_month_is_rewritten(spark, tmp, table):
    first = [sale(1, "2024-05-05"), sale(2, "2024-01-05")]
    second = [sale(1, "2024-01-20"), sale(4, "2024-01-21"), sale(5, "nunca")]  # V1 again with an older date, in a month that changes
    table.apply(spark.createDataFrame(first, SALES), dims(spark))
    assert table.apply(spark.createDataFrame(second, SALES), dims(spark)) == [0, 202401]
    assert rows(table) == rebuilt(spark, tmp, [first, second], dims(spark))


def test_dimension_changes_rewrite_the_months_of_their_sales(spark, tmp, table):
    first = [sale(1, "2024-01-05"), sale(2, "2024-02-05", customer="C2"), sale(3, "2024-03-05", customer="C2", game="P2"), sale(4, "2024-04-05", customer="C3", game="P3")]
    none = spark.createDataFrame([], SALES)
    table.apply(spark.createDataFrame(first, SALES), dims(spark))
    renamed = dims(spark, customers=(("C1", "Ana"), ("C2", "Beatriz")))
    assert table.apply(none, renamed) == [202402, 202403]
    assert table.apply(none, dims(spark, customers=(("C1", "Ana"),), votes=7)) == [202401, 202402, 202403]  # C2 is gone, P1 has other votes
    now = dims(spark, customers=(("C1", "Ana"), ("C3", "Carla")), votes=7)
    assert table.apply(none, now) == [202404]
    assert rows(table) == rebuilt(spark, tmp, [first], now)


def test_a_delivery_that_stopped_between_months_is_completed_by_repeating_it(spark, tmp, table):
    first, moved = [sale(1, "2024-01-05"), sale(2, "2024-02-05")], [sale(1, "2024-02-10"), sale(2, "2024-03-01")]
    table.apply(spark.createDataFrame(first, SALES), dims(spark))
    # as if only February had been swapped: V1 is in January and in February
    half = cleanse.clean_sales(spark.createDataFrame([moved[0]], SALES)).select(*cleanse.RAW_SALES_COLUMNS)
    table._wide(half, dims(spark)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*inc.MONTH).parquet(table.path)
    assert len(rows(table)) == 2
    table.apply(spark.createDataFrame(moved, SALES), dims(spark))
    assert rows(table) == rebuilt(spark, tmp, [first, moved], dims(spark))


def test_sales_without_any_date(spark, tmp, table):
    first = [sale(1, "x"), sale(2, None)]
    assert table.apply(spark.createDataFrame(first, SALES), dims(spark)) == [0]
    assert table.apply(spark.createDataFrame([sale(2, "2024-01-01")], SALES), dims(spark)) == [0, 202401]
    assert rows(table) == rebuilt(spark, tmp, [first, [sale(2, "2024-01-01")]], dims(spark))


def test_the_first_delivery_is_not_compared_and_dimensions_are_worked_out_once(spark, table, monkeypatch):
    compare = inc.changed_sales
    monkeypatch.setattr(inc, "changed_sales", lambda old, new: pytest.fail("there is no table to compare with"))
    seen = spark.sparkContext.accumulator(0)

    def once(key):
        seen.add(1)
        return key

    now = dims(spark)
    now["customers"] = now["customers"].withColumn("cliente_id", F.udf(once)("cliente_id"))
    assert table.apply(spark.createDataFrame([sale(1, "2024-01-05"), sale(2, "2024-02-05")], SALES), now) == [202401, 202402]
    assert seen.value == 2  # one call for each of the two customers
    monkeypatch.setattr(inc, "changed_sales", compare)
    changed = compare(table.read(), cleanse.clean_sales(spark.createDataFrame([sale(2, "2024-03-01"), sale(9, "2024-01-01")], SALES)).select(*cleanse.RAW_SALES_COLUMNS))
    assert sorted((r.venta_id, r.added, str(r.fecha), str(r.before)) for r in changed.collect()) == [
        ("V2", False, "2024-03-01", "2024-02-05"), ("V9", True, "2024-01-01", "None")]


def test_shuffles_of_the_wide_table_carry_no_derived_columns(spark):
    now = dims(spark)
    sales = cleanse.clean_sales(spark.createDataFrame([sale(1, "2024-05-05", price=2.5, units=3)], SALES))
    wide = integrate.wide_sales(sales, now["customers"], now["catalog"], now["scores"], now["activity"])
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "quarter(" in plan and plan.rindex("quarter(") < plan.index("Join")
    r = wide.first()
    assert (r.mes, r.anio, r.trimestre, r.total, r.nombre, r.titulo) == (5, 2024, 2, 7.5, "Ana", "Uno")
    assert wide.columns[:13] == cleanse.SALES_COLUMNS
