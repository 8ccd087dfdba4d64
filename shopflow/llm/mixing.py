"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Tokens (words) are summed per cell of source, language and topic. Raking scales
the cells' weights to the target share of each source, then of each language, then of
each topic, again and again. A document's sampling probability is
``min(1, scale * weight / tokens)`` of its cell, with one scale for all cells, calibrated
so that the expected sample holds ``share`` of all tokens; a hash of the
``doc_id`` decides, so a rerun samples the same documents.

Targets default to tempered shares (tokens to the power ``temper``); others can be
given as {value: share} per marginal, where values that are not named keep nothing.

Defined results: null source or language is the value ``(none)``. A null text
has no tokens; a cell without tokens keeps all its documents. Rows with the same ``doc_id`` share
their fate. A null ``doc_id`` is hashed as the empty string. Other columns are ignored by
:func:`weigh` and kept by :func:`sample`. An empty table gives no rows.

Scale: one partial aggregation over the documents; raking works on the cell
table, one row per cell, with windows partitioned by the raked marginal. The cell
table is broadcast only when its counted rows are below ``BROADCAST_ROWS``,
and joined by shuffle beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import cut, words

MARGINS = ("source", "lang", "topic")
#: Power of a value's tokens that its target share follows.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 1.0}
ROUNDS = 10
SCALE_ROUNDS = 8
SHARE = 0.75
#: Rows of the cell table (about 100 bytes each) up to which it is broadcast.
BROADCAST_ROWS = 100_000
CELL = [f"_cell_{m}" for m in MARGINS]


def topic_of(text: Column) -> Column:
    """Topic by content: credentials, license notices, contacts, tables, else prose."""
    text = F.coalesce(text, F.lit(""))
    assigned = (text.contains("=") | text.contains(":")) & text.rlike(r"""(?i)(password|secret|token|api_?key)["']?\x20*[:=]""")
    return (F.when(assigned, "credential").when(text.contains("License") | text.contains("Licensed under"), "license")
            .when(text.contains("@"), "contact").when(text.contains(" | "), "table").otherwise("prose"))


def keys(df: DataFrame, topic: Column | None = None) -> list[Column]:
    """The cell columns of documents."""
    none = F.lit("(none)")
    return [F.coalesce(F.col("source").cast("string"), none).alias(CELL[0]), F.coalesce(F.col("lang").cast("string"), none).alias(CELL[1]),
            F.coalesce(topic if topic is not None else topic_of(F.col("text")), none).alias(CELL[2])]


def tokens(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def rake(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (cell columns, tokens) with ``weight``, in tokens, raked to the targets."""
    named = targets or {}
    for key, margin in zip(CELL, MARGINS):
        total = F.sum("tokens").over(Window.partitionBy(key)).cast("double")
        if margin in named:
            share = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in named[margin].items() for x in kv]), F.col(key)).cast("double"), F.lit(0.0))
        else:
            share = F.pow(total, F.lit(TEMPER[margin]))
        cells = cells.withColumn(f"{key}_target", share)
    cells = cut(cells.withColumn("weight", F.col("tokens").cast("double")), "mix_targets")
    for i in range(rounds):
        for key in CELL:
            now = F.sum("weight").over(Window.partitionBy(key))
            cells = cells.withColumn("weight", F.when(now > 0, F.col("weight") * F.col(f"{key}_target") / now).otherwise(F.lit(0.0)))
        if i % 2:  # the plan stays short
            cells = cut(cells, "mix_rake")
    return cells.select(*CELL, "tokens", "weight")


def calibrate(cells: DataFrame, share: float = SHARE, rounds: int = SCALE_ROUNDS) -> DataFrame:
    """Raked cells with ``weight`` per token (1 on average) and the sampling ``probability``.

    The scale grows to its fixed point: cells that reach probability 1 leave
    the rest of the budget to the others. Only sums reach the driver.
    """
    cells = cut(cells, "mix_raked")
    total, weight = cells.agg(F.sum("tokens"), F.sum("weight")).first()
    if not total or not weight:
        return cells.select(*CELL, F.lit(1.0).alias("weight"), F.lit(1.0).alias("probability"))
    budget, scale = share * total, share * total / weight
    for _ in range(rounds):
        full = F.col("weight") * scale >= F.col("tokens")
        held, rest = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(F.lit(0))), F.sum(F.when(~full, F.col("weight")).otherwise(F.lit(0.0)))).first()
        if not rest or held >= budget:
            break
        scale = (budget - held) / rest
    empty = F.col("tokens") == 0
    per_token = F.col("weight") / F.col("tokens")
    return cells.select(*CELL, F.when(empty, 1.0).otherwise(F.round(per_token * (total / weight), 6)).alias("weight"),
                        F.when(empty, 1.0).otherwise(F.round(F.least(F.lit(1.0), per_token * scale), 6)).alias("probability"))


def cell_probabilities(rows: DataFrame, *, targets=None, share: float = SHARE) -> DataFrame:
    """The calibrated cells of ``rows`` (cell columns, n_tokens), ready to join."""
    cells = cut(rows.groupBy(*CELL).agg(F.sum("n_tokens").alias("tokens")), "mix_cells")
    found = cut(calibrate(rake(cells, targets), share), "mix_probabilities")
    return F.broadcast(found) if found.count() <= BROADCAST_ROWS else found


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from a document's id."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def weigh(docs: DataFrame, *, topic: Column | None = None, **options) -> DataFrame:
    """One row per document: cell, tokens, weight per token, probability and the decision."""
    rows = cut(docs.select("doc_id", *keys(docs, topic), tokens(F.col("text")).alias("n_tokens")), "mix_documents")
    return rows.join(cell_probabilities(rows, **options), CELL).select(
        "doc_id", *[F.col(c).alias(m) for c, m in zip(CELL, MARGINS)], "n_tokens", "weight", "probability",
        (uniform(F.col("doc_id")) < F.col("probability")).alias("selected"))


def sample(docs: DataFrame, *, topic: Column | None = None, **options) -> DataFrame:
    """The sampled rows of ``docs`` with their own columns; texts are not shuffled while the cells can be broadcast."""
    cells = docs.select(*keys(docs, topic), tokens(F.col("text")).alias("n_tokens"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*own).alias("_row"), *keys(docs, topic))
    found = cell_probabilities(cells, **options).drop("weight").withColumnRenamed("probability", "_probability")
    return rows.join(found, CELL).where(uniform(F.col("_row.doc_id")) < F.col("_probability")).select("_row.*")


def sql(share: float = SHARE, rounds: int = ROUNDS, scale_rounds: int = SCALE_ROUNDS) -> str:
    """DuckDB SQL for :func:`weigh` with default targets."""
    steps = []
    for i in range(rounds):
        for m in MARGINS:
            steps.append(f"r{len(steps) + 1} AS (SELECT * REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY {m}) > 0 "
                         f"THEN weight * {m}_target / sum(weight) OVER (PARTITION BY {m}) ELSE 0 END AS weight) FROM r{len(steps)})")
    raked = f"r{len(steps)}"
    scales = [f"s0 AS (SELECT {share} * sum(tokens) / sum(weight) AS scale FROM {raked})"]
    for i in range(scale_rounds):
        scales.append(
            f"s{i + 1} AS (SELECT CASE WHEN rest > 0 AND held < {share} * total THEN ({share} * total - held) / rest ELSE scale END AS scale FROM ("
            f"SELECT any_value(scale) AS scale, sum(tokens) AS total, sum(CASE WHEN weight * scale >= tokens THEN tokens ELSE 0 END) AS held, "
            f"sum(CASE WHEN weight * scale >= tokens THEN 0 ELSE weight END) AS rest FROM {raked}, s{i}))")
    targets = ", ".join(f"power(CAST(sum(tokens) OVER (PARTITION BY {m}) AS DOUBLE), {TEMPER[m]}) AS {m}_target" for m in MARGINS)
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, coalesce(text, '') AS text FROM documents),
k AS (
  SELECT doc_id, source, lang, CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
    CASE WHEN regexp_matches(text, '(?i)(password|secret|token|api_?key)["'']?\x20*[:=]') THEN 'credential'
         WHEN contains(text, 'License') OR contains(text, 'Licensed under') THEN 'license'
         WHEN contains(text, '@') THEN 'contact' WHEN contains(text, ' | ') THEN 'table' ELSE 'prose' END AS topic FROM d),
c AS (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM k GROUP BY ALL),
r0 AS (SELECT *, CAST(tokens AS DOUBLE) AS weight, {targets} FROM c),
{", ".join(steps)},
{", ".join(scales)},
p AS (
  SELECT source, lang, topic, CASE WHEN tokens = 0 THEN 1.0::DOUBLE ELSE round(weight / tokens * (total / total_weight), 6) END AS weight,
    CASE WHEN tokens = 0 THEN 1.0::DOUBLE ELSE round(least(1.0, weight / tokens * scale), 6) END AS probability
  FROM {raked}, s{scale_rounds}, (SELECT sum(tokens) AS total, sum(weight) AS total_weight FROM {raked}))
SELECT doc_id, source, lang, topic, n_tokens, weight, probability,
  CAST('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0 < probability AS selected
FROM k JOIN p USING (source, lang, topic)
"""
