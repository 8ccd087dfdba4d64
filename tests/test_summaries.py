"""Stored month summaries: merged sketches against exact counts, best sellers against a plain count, drift."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopflow.operators import summaries as sm

SALES = "anio int, mes int, cliente_id string, juego_id string, precio double, cantidad int"


def sales(spark, rows):
    return spark.createDataFrame(rows, SALES)


def best(rows, k):
    out = []
    for period in {"todo", *[str(r[0]) for r in rows if r[0] is not None]}:
        n = Counter()
        for y, _, _, g, _, u in rows:
            if g is not None and u and period in ("todo", str(y)):
                n[g] += u
        out += [(period, i + 1, g, u) for i, (g, u) in enumerate(sorted(n.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out)


def got(spark, rows, k, kept):
    df = sales(spark, rows)
    out = sm.top_games(sm.game_summaries(df, kept), df, k, kept)
    return sorted((r.periodo, r.puesto, r.juego_id, r.unidades) for r in out.collect())


@pytest.mark.parametrize("kept", [1, 3, 8, 1000])
def test_best_sellers_are_exact_however_few_games_a_month_keeps(spark, kept):
    rng = random.Random(kept)
    rows = []
    for _ in range(600):
        hot = rng.random() < 0.33  # one game with a third of all sales
        rows.append((rng.choice([2020, 2021, 2022, None]), None, "C1", "HOT" if hot else f"P{int(rng.paretovariate(0.8)) % 40}", 1.0, rng.randrange(0, 4)))
    rows = [(y, rng.randrange(1, 13) if y else None, *r) for y, _, *r in rows] + [(2020, 1, "C1", None, 1.0, 9), (2020, 1, "C1", "P1", 1.0, None)]
    assert got(spark, rows, 3, kept) == best(rows, 3)


def test_best_sellers_ties_unseen_games_and_no_sales(spark):
    # each month keeps one game; B is second in both and the best over all
    rows = [(2020, 1, "C", "A", 1.0, 5), (2020, 1, "C", "B", 1.0, 4), (2020, 2, "C", "Z", 1.0, 5), (2020, 2, "C", "B", 1.0, 4)]
    assert got(spark, rows, 1, 1) == [("2020", 1, "B", 8), ("todo", 1, "B", 8)]
    tied = [(2020, 1, "C", g, 1.0, 2) for g in "DCBA"]
    assert got(spark, tied, 2, 1) == best(tied, 2)
    assert got(spark, [], 2, 1) == []


def test_facts_are_not_read_for_games_that_every_month_stores(spark):
    rows = [(2020, m, "C", g, 1.0, u) for m in (1, 2) for g, u in (("A", 50), ("B", 40), ("X", 1), (f"Y{m}", 1))]
    df = sales(spark, rows)
    kept = sm.game_summaries(df, 2)
    none = df.filter(F.lit(False))  # A and B are stored in both months; no other game can reach 80
    assert sorted((r.periodo, r.juego_id, r.unidades) for r in sm.top_games(kept, none, 2, 2).collect()) == [
        ("2020", "A", 100), ("2020", "B", 80), ("todo", "A", 100), ("todo", "B", 80)]


def test_distinct_counts_merge_within_their_bound(spark):
    # 120,000 customers, half of them in two months: sums of months would count them twice
    df = spark.range(180_000).select(F.lit(2020).alias("anio"), (F.col("id") % 12 + 1).cast("int").alias("mes"), F.concat(F.lit("C"), F.col("id") % 120_000).alias("cliente_id"),
                                     F.lit("P1").alias("juego_id"), F.col("id").cast("double").alias("precio"), F.lit(1).alias("cantidad"))
    months = sm.month_summaries(df)
    row = sm.merged(months).select(sm.distinct("clientes").alias("c"), sm.distinct("juegos").alias("j")).first()
    assert abs(row.c - 120_000) <= 120_000 * sm.DISTINCT_ERROR and row.j == 1
    direct = sm.month_summaries(df.withColumn("t", F.lit(1)), "t").select(sm.distinct("clientes").alias("c")).first().c
    assert abs(direct - row.c) <= 120_000 * sm.DISTINCT_ERROR
    for rank in (0.01, 0.5, 0.99):
        q = sm.merged(months).select(sm.quantile("precio", rank).alias("q")).first().q
        assert abs(q / 180_000 - rank) <= sm.RANK_ERROR


def test_nulls_and_empty_tables(spark):
    df = sales(spark, [(2020, 1, None, None, None, None), (None, None, "C1", "P1", 2.0, 1)])
    one = sm.merged(sm.month_summaries(df).filter("anio = 2020")).select(sm.distinct("clientes").alias("c"), sm.quantile("precio", 0.5).alias("q")).first()
    assert (one.c, one.q) == (0, None)
    assert sm.month_summaries(sales(spark, [])).count() == 0
    months = sm.month_summaries(df)
    moved = sm.drift(sm.merged(months.filter("anio = 2020")), sm.merged(months.filter("anio is null")), ("precio",)).first()
    assert (moved.distancia, moved.deriva) == (None, False)


def test_drift_of_a_planted_shift_only(spark):
    rng = random.Random(3)
    day = dt.date(2020, 1, 1)

    def one(scale, units):
        rows = [((day + dt.timedelta(days=i % 360)).year, i % 12 + 1, "C", "P", rng.uniform(10, 60) * scale, rng.choice(units)) for i in range(4000)]
        return sm.month_summaries(sales(spark, rows).withColumn("e", F.lit(1)), "e")
    base = one(1, [1, 2, 3])
    flags = {n: {r.columna: r.deriva for r in sm.drift(base, other).collect()} for n, other in
             {"same": one(1, [1, 2, 3]), "price": one(1.3, [1, 2, 3]), "units": one(1, [1, 1, 1, 2])}.items()}
    assert flags == {"same": {"precio": False, "cantidad": False}, "price": {"precio": True, "cantidad": False}, "units": {"precio": False, "cantidad": True}}
