"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Base statistics come from whole texts: words, their code points, symbols,
repeated lines and words in repeated 8-word windows. Texts that fail the base
rules go. The others get a vector of transformed statistics, and per language
and source a minimum-covariance-determinant estimate (start from medians and
quartiles, then concentration steps: the ``support`` share of rows with the
smallest distances gives the next mean and covariance). Texts whose squared
Mahalanobis distance is beyond the chi-square cut are rejected.

Small (language, source) groups are judged by all rows of their language, or by
all rows if the language is small too; only a table with fewer than ``MIN_ALL``
passing texts rejects nothing beyond the base rules.

Defined results: null text counts as empty and fails the base rules. Null
language or source is a group value of its own. Every row is judged by itself, so
repeated rows get the same verdict. An empty table gives no rows. Other
columns are ignored by :func:`judge` and kept by :func:`keep_clean`.

Scale: texts are read once and never shuffled; statistics are aggregated
partially, so a group with a third of all rows arrives as one row per task; the
group table has one row per language and source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import WHITE_CLASS, cut, small, words

WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
N = 4
#: Standard deviations below which a coordinate's spread is not trusted (a constant statistic has none). At TAIL, where
#: a group has no spread of its own, a text goes by repeated lines alone from a share of 0.6 on, and by repeated words
#: alone from 0.29 on (the base rule takes those above 0.30).
FLOORS = (0.35, 0.25, 0.314, 0.22)
#: Words after which a longer text says no more about its mean word length.
SATURATION = 400.0
MIN_GROUP = 100
#: Rows of the whole table below which four statistics have no estimate.
MIN_ALL = 5 * N
SUPPORT = 0.75
STEPS = 3
TAIL = 1e-7
PACKED = "_quality_statistics"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body's lambdas use it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(h: Column) -> Column:
    """Words that lie in a window of 8 that occurs twice or more, from the array of word hashes.

    Only texts with a repeated window pay for the sort that finds its places.
    """
    windows = F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW)))

    def same(s: Column, k: Column, x: Column) -> Column:
        return F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))

    def places(s: Column) -> Column:
        return F.sort_array(F.transform(F.filter(s, lambda x, k: same(s, k - 1, x) | same(s, k + 1, x)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def counted(g: Column) -> Column:
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(ordered, lambda s: let(places(s), covered)))

    return F.when(F.size(h) < WINDOW, F.lit(0)).otherwise(let(windows, counted))


def statistics(text: Column) -> Column:
    """Struct of the base statistics and the number of lines with a word."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words_part = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        let(F.transform(w, lambda x: F.xxhash64(x)), repeat_words).cast("long").alias("n_repeat_words")))
    lines_part = let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long")
    return F.struct(words_part.alias("w"), lines_part.alias("l"), symbols.alias("n_symbols"))


def unpacked(packed: str) -> dict[str, Column]:
    c = F.col(packed)
    return {"n_words": c["w"]["n_words"], "word_chars": c["w"]["word_chars"], "n_symbols": c["n_symbols"],
            "n_dup_lines": c["l"]["n_dup_lines"], "n_repeat_words": c["w"]["n_repeat_words"], "n_lines": c["l"]["n_lines"]}


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < 20) | (n_repeat * 100 > n_words * 30)


def vector(s: dict[str, Column], center: Column) -> list[Column]:
    """The transformed statistics.

    The mean word length is taken against its group's median and scaled by the
    root of the words that it is a mean of; the shares are damped by a logarithm.
    """
    n = F.greatest(s["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(s["word_chars"], F.lit(1)).cast("double")
    lines = F.greatest(s["n_lines"], F.lit(1)).cast("double")
    return [(s["word_chars"] / n - center) * F.sqrt(n / (1 + n / SATURATION)) / 2,
            F.log1p(s["n_symbols"] / chars * 100), F.log1p(s["n_dup_lines"] / lines * 10), F.log1p(s["n_repeat_words"] / n * 10)]


def chi2_below(x: float, half: int) -> float:
    """P(chi-square with 2 * half degrees <= x)."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(half))


def chi2_point(p: float, half: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_below(mid, half) < p else (low, mid)
    return low


def consistency(support: float) -> float:
    """What makes the covariance of the central ``support`` share unbiased for normal data."""
    return support / chi2_below(chi2_point(support, N // 2), N // 2 + 1)


def factors(variance) -> list[Column]:
    """Mean-free lower Cholesky factor of a covariance given as columns: l00, l10, l11, ..."""
    low: dict[tuple[int, int], Column] = {}
    for i in range(N):
        for j in range(i + 1):
            rest = variance(i, j) - sum((low[i, k] * low[j, k] for k in range(j)), F.lit(0.0))
            low[i, j] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / low[j, j]
    return [low[i, j].alias(f"l{i}{j}") for i in range(N) for j in range(i + 1)]


def distance(x: list[Column]) -> Column:
    """Squared Mahalanobis distance of ``x`` under the row's m0.. and l00.. columns."""
    z: list[Column] = []
    for i in range(N):
        rest = x[i] - F.col(f"m{i}") - sum((F.col(f"l{i}{k}") * z[k] for k in range(i)), F.lit(0.0))
        z.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in z), F.lit(0.0))


def groups(stats: DataFrame, min_group: int) -> DataFrame:
    """(lang_key, source_key) -> grp that judges its rows, and feeds: the groups that its rows are estimated in.

    A group below ``min_group`` rows is judged by all rows of its language, or
    by all rows where the language is below ``min_group`` too.
    """
    cells = cut(stats.groupBy("lang_key", "source_key").agg(F.count(F.lit(1)).alias("n")), "quality_cells")
    per_lang = cells.groupBy("lang_key").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least"))
    own, lang, every = F.to_json(F.struct("lang_key", "source_key")), F.to_json(F.struct("lang_key")), F.lit("*")
    few = F.col("n_lang") < min_group
    keyed = cut(cells.join(per_lang, "lang_key").select(
        "lang_key", "source_key",
        F.when(F.col("n") >= min_group, own).when(~few, lang).otherwise(every).alias("grp"),
        F.array_compact(F.array(
            F.when(F.col("n") >= min_group, own),
            F.when(~few & (F.col("least") < min_group), lang))).alias("feeds"), few.alias("few")), "quality_groups")
    fallback = F.when(F.lit(bool(keyed.where("few").head(1))), F.array(every)).otherwise(F.array().cast("array<string>"))
    return keyed.select("lang_key", "source_key", "grp", F.concat("feeds", fallback).alias("feeds"))


def estimate(rows: DataFrame, *, min_group: int = MIN_GROUP, support: float = SUPPORT, steps: int = STEPS) -> DataFrame:
    """Robust centre and covariance factor per (lang_key, source_key); rows hold the base statistics."""
    stats = rows.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    keyed = small(groups(stats, min_group))
    ratio = F.col("word_chars") / F.col("n_words")
    stats = stats.join(keyed.drop("grp"), ["lang_key", "source_key"]).withColumn("grp", F.explode("feeds")).drop("feeds")
    centers = stats.groupBy("grp").agg(F.count(F.lit(1)).alias("n_grp"), F.percentile_approx(ratio, 0.5, 10000).alias("center"))
    names = [f"x{i}" for i in range(N)]
    x = vector({k: F.col(k) for k in (*BASE, "n_lines")}, F.col("center"))
    # Text-free rows, a few numbers each: the steps below read this table, not the texts.
    points = cut(stats.join(small(cut(centers, "quality_centers")), "grp").select(
        "grp", "n_grp", "center", *[v.alias(n) for v, n in zip(x, names)]), "quality_points")
    quartiles = points.groupBy("grp", "n_grp", "center").agg(*[F.percentile_approx(n, [0.25, 0.5, 0.75], 10000).alias(n) for n in names])
    spread = [F.greatest((F.col(n)[2] - F.col(n)[0]) / 1.349, F.lit(f)) for n, f in zip(names, FLOORS)]
    model = quartiles.select("grp", "n_grp", "center", *[F.col(n)[1].alias(f"m{i}") for i, n in enumerate(names)],
                             *factors(lambda i, j: spread[i] * spread[i] if i == j else F.lit(0.0)))
    factor = consistency(support)
    for step in range(steps):
        model = cut(model, f"quality_model{step}")
        near = points.join(small(model).drop("n_grp", "center"), "grp").select("grp", "n_grp", "center", *names, distance([F.col(n) for n in names]).alias("d"))
        limit = near.groupBy("grp").agg(F.percentile_approx("d", support, 10000).alias("limit"))
        inner = near.join(small(cut(limit, f"quality_limit{step}")), "grp").where("d <= limit")
        moments = inner.groupBy("grp", "n_grp", "center").agg(
            *[F.avg(n).alias(f"m{i}") for i, n in enumerate(names)],
            *[F.covar_pop(names[i], names[j]).alias(f"c{i}{j}") for i in range(N) for j in range(i + 1)])
        model = moments.select("grp", "n_grp", "center", *[f"m{i}" for i in range(N)], *factors(
            lambda i, j: F.greatest(F.col(f"c{i}{j}") * factor, F.lit(FLOORS[i] ** 2)) if i == j else F.col(f"c{i}{j}") * factor))
    model = model.where(F.col("n_grp") >= min(min_group, MIN_ALL)).drop("n_grp")
    return small(cut(keyed.drop("feeds").join(model, "grp").drop("grp"), "quality_estimate"))


def _keys(df: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("\x00null")).alias(f"{c}_key") for c in ("lang", "source")]


def _judged(rows: DataFrame, model: DataFrame, s: dict[str, Column], keep: list[Column], tail: float) -> DataFrame:
    failed = base_failed(s["n_words"], s["n_repeat_words"])
    d = distance(vector(s, F.col("center")))
    return rows.join(model, ["lang_key", "source_key"], "left").select(
        *keep, failed.alias("base_failed"), (~failed & F.coalesce(d <= chi2_point(1 - tail, N // 2), F.lit(True))).alias("kept"),
        F.when(~failed, d).alias("distance"))


def judge(docs: DataFrame, *, tail: float = TAIL, **options) -> DataFrame:
    """One row per document: base statistics, base verdict, final verdict and squared distance."""
    packed = docs.select("doc_id", *_keys(docs), statistics(F.col("text")).alias(PACKED))
    rows = cut(packed.select("doc_id", "lang_key", "source_key", *[v.alias(k) for k, v in unpacked(PACKED).items()]), "quality_stats")
    s = {k: F.col(k) for k in (*BASE, "n_lines")}
    return _judged(rows, estimate(rows, **options), s, ["doc_id", *BASE], tail)


def keep_clean(docs: DataFrame, *, tail: float = TAIL, **options) -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with their own columns.

    The texts and their statistics are written once, so the statistics are
    computed once and the texts are not shuffled.
    """
    own = [c for c in docs.columns]
    keep = F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row")
    rows = cut(docs.select(keep, *_keys(docs), statistics(F.col("text")).alias(PACKED)), "quality_rows")
    s = unpacked(PACKED)
    stats = rows.select("lang_key", "source_key", *[v.alias(k) for k, v in s.items()])
    judged = _judged(rows, estimate(stats, **options), s, ["_row"], tail)
    return judged.where("kept").select("_row.*")
