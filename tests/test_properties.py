"""Property tests: column builders and dedupe against plain-Python models
on random inputs (one DataFrame per example, a handful of examples)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopflow.functions import columns as C
from shopflow.operators import cleanse

SETTINGS = settings(max_examples=6, deadline=None)
WORDS = ["ps5", "PS4", "xbox", "Series", "PlayStation 5", "playstation 4", "nintendo", "Switch",
         "pc", "Sega", " ", "  ", "5", "PLAY"]


def model_platform(x):
    if x is None:
        return None
    v = x.strip(" ").upper()
    for needle, label in C.PLATFORM_RULES:
        if needle in v:
            return label
    return v


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.lists(st.sampled_from(WORDS), max_size=4).map("".join)),
                min_size=1, max_size=200))
def test_canonical_platform_matches_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "p string")
    got = [r[0] for r in df.select(C.canonical_platform("p")).collect()]
    assert got == [model_platform(v) for v in values]


cents = st.integers(min_value=0, max_value=10_000_000)


def half_up(x: Decimal, q: str) -> Decimal:
    return x.quantize(Decimal(q), rounding=ROUND_HALF_UP)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), cents, st.integers(1, 9)), min_size=1, max_size=300))
def test_money_aggregates_match_decimal_model(spark, rows):
    data = [(g, c / 100, q) for g, c, q in rows]
    df = spark.createDataFrame(data, "g int, precio double, cantidad int").withColumn(
        "total", C.line_total("precio", "cantidad"))
    got = {r.g: (r.s, r.a, r.ap) for r in df.groupBy("g").agg(
        C.money_sum("total").alias("s"), C.money_avg("total").alias("a"),
        C.money_avg("precio").alias("ap")).collect()}
    for g in {g for g, _, _ in rows}:
        totals = [Decimal(c) / 100 * q for gg, c, q in rows if gg == g]
        prices = [Decimal(c) / 100 for gg, c, _ in rows if gg == g]
        s = half_up(sum(totals), "0.01")
        assert got[g][0] == float(s)
        assert got[g][1] == float(half_up(sum(totals) / len(totals), "0.01"))
        assert got[g][2] == float(half_up(sum(prices) / len(prices), "0.01"))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(1, 1000)), min_size=1, max_size=50))
def test_pct_of_matches_decimal_model(spark, pairs):
    pairs = [(min(a, b), b) for a, b in pairs]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(C.pct_of("a", "b")).collect()]
    assert got == [float(half_up(Decimal(a) * 100 / Decimal(b), "0.1")) for a, b in pairs]


keys = st.sampled_from(["k1", "k2", "k3", "k4"])
vals = st.one_of(st.none(), st.integers(0, 5))


@SETTINGS
@given(st.lists(st.tuples(keys, vals, vals, st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
                min_size=1, max_size=120),
       st.booleans(), st.integers(1, 7))
def test_dedupe_matches_model(spark, rows, latest, parts):
    df = spark.createDataFrame(rows, "k string, o int, x int, s string").repartition(parts)
    got = sorted(tuple(r) for r in cleanse.dedupe(df, ["k"], ["o"], latest=latest).collect())

    def sort_key(r):  # NULL lowest, then value, field by field: (o, x, s)
        return tuple((v is not None, v) for v in (r[1], r[2], r[3]))
    want = []
    for k in sorted({r[0] for r in rows}):
        group = [r for r in rows if r[0] == k]
        want.append((max if latest else min)(group, key=sort_key))
    assert got == sorted(want)
    assert F is not None
