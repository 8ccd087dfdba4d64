"""Dedupe, explode, cleansing, log counting."""

import datetime as dt

from shopflow.operators import cleanse, logs
from shopflow.schemas import CATALOG, SALES


def test_dedupe_total_order_latest_and_nulls(spark):
    df = spark.createDataFrame(
        [("k1", "2024-01-01", 5), ("k1", "2024-02-01", 1), ("k1", None, 9),
         ("k2", None, 3), ("k2", None, 4), ("k3", "2024-01-01", 1)], "k string, d string, v int")
    got = sorted(tuple(r) for r in cleanse.dedupe(df, ["k"], ["d"]).collect())
    assert got == [("k1", "2024-02-01", 1), ("k2", None, 4), ("k3", "2024-01-01", 1)]
    first = sorted(tuple(r) for r in cleanse.dedupe(df, ["k"], ["d"], latest=False).collect())
    assert first == [("k1", None, 9), ("k2", None, 3), ("k3", "2024-01-01", 1)]


def test_dedupe_independent_of_partitioning(spark):
    df = spark.range(2000).selectExpr("cast(id % 7 as string) k", "id v")
    a = sorted(tuple(r) for r in cleanse.dedupe(df.repartition(1), ["k"], ["v"]).collect())
    b = sorted(tuple(r) for r in cleanse.dedupe(df.repartition(13), ["k"], ["v"]).collect())
    assert a == b and len(a) == 7


def test_clean_sales_cases(spark):
    raw = spark.createDataFrame([
        ("V1", "2024-01-05", "c1", " jv001 ", "ps5", 10.0, 2, "Yape", "S1"),
        ("V1", "2024-01-06", "c1", "JV001", "PS5", 12.0, 1, "Yape", "S1"),   # duplicate id, later
        ("V2", "bad", "C2", "JV002", "Xbox Series X", 5.0, 1, "Plin", "S2"),  # bad date
        ("V3", "2024-02-01", "C3", "JV003", "Switch", 0.0, 1, "Plin", "S2"),  # price 0
        ("V4", "2024-02-01", "C3", "JV003", "Switch", -1.0, 1, "Plin", "S2"),  # negative
        ("V5", "2024-02-01", "C3", "JV003", "Switch", None, 1, "Plin", "S2"),  # NULL price
    ], SALES)
    out = {r.venta_id: r for r in cleanse.clean_sales(raw).collect()}
    assert sorted(out) == ["V1", "V2"]
    assert out["V1"].fecha == dt.date(2024, 1, 6) and out["V1"].total == 12.0
    assert out["V1"].juego_id == "JV001" and out["V1"].cliente_id == "C1"
    assert (out["V1"].mes, out["V1"].anio, out["V1"].trimestre) == (1, 2024, 1)
    assert out["V2"].fecha is None and out["V2"].mes is None and out["V2"].plataforma == "XBOX"


def test_catalog_explode_collapses_spellings(spark):
    raw = spark.createDataFrame([
        ("jv1", "A", "RPG", ["Xbox One", "XBOX Series S", "PlayStation 5"], 10.0, "d", "p", 2020, 12, "x", ["t"]),
        ("JV2", "B", "RPG", [], 10.0, "d", "p", 2020, 12, "x", None),
        ("JV3", "C", "RPG", None, 10.0, "d", "p", 2020, 12, "x", None),
    ], CATALOG)
    got = sorted((r.juego_id, r.plataforma) for r in cleanse.catalog_exploded(raw).collect())
    assert got == [("JV1", "PS5"), ("JV1", "XBOX")]
    outer = sorted((r.juego_id, r.plataforma) for r in cleanse.catalog_exploded(raw, outer=True).collect())
    assert ("JV2", None) in outer and ("JV3", None) in outer


def test_log_counting_fixes_key_extraction(spark):
    lines = spark.createDataFrame([
        ("2024-01-05 10:00:00 INFO C001 PURCHASE JV001",),
        ("2024-01-05 10:01:00 INFO C001 LOGIN",),
        ("2024-01-05 10:02:00   INFO   C002   PURCHASE   JV002",),     # several blanks
        ("2024-01-05 10:03:00 WARN SISTEMA PURCHASE retry C001",),     # system line
        ("2024-01-05 10:04:00 INFO C002 VIEW_GAME PURCHASE-GUIDE",),   # title holds the word
        ("C003 PURCHASE",),                                            # under three tokens
        ("",),
        ("2024-01-05 10:05:00 INFO C002 LOGIN",),
        ("2024-01-05 10:06:00 INFO C002 LOGOUT",),
    ], "value string")
    got = sorted(tuple(r) for r in logs.log_activity(lines).collect())
    assert got == [("C001", 1, 1), ("C002", 1, 1)]
