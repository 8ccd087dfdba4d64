"""URL filters by a character language-model ratio, in DataFrame functions only.

Fixed rules (host and path prefix, longest wins) decide where they fit. The
urls they accept and reject train two smoothed variable-order Markov models of
characters (contexts of up to four characters; an order is interpolated with the
next shorter one by its pseudo-count). The other urls are accepted when the
mean log-likelihood difference per character is at least a threshold,
calibrated on the rule-judged urls between the two classes' means, nearer to the
narrower class.

Defined results: a null url or one without ``://`` has an empty host and
path and is judged by the models like any other text. Without rule-judged urls of
both classes the models say nothing, and all are accepted. Repeated rows are judged each.
Other columns are ignored. An empty table gives no rows.

Scale: all characters are counted in one pass with partial aggregation into distinct
5-character grams; lower orders are summed from those grams, and each gram gets one
score. Distinct urls are scored by a join with the grams, which are broadcast only when
their counted rows are below ``BROADCAST_ROWS`` and joined by shuffle beyond.
Scores are summed as whole numbers of 1e-6, so sums do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import cut

#: Fixed rules: verdict, host, path prefix.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ORDER = 4
#: Pseudo-count that the next shorter context has, and the size of the alphabet behind the shortest.
PSEUDO, ALPHABET = 2.0, 256
#: Grams (about 40 bytes each) up to which their scores are broadcast.
BROADCAST_ROWS = 500_000
PARTS = r"://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null fields if none does."""
    out = F.struct(F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(text: Column) -> Column:
    """Each character with the four before it; the text's ends are marked."""
    padded = F.concat(F.lit("^" * ORDER), text, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))


def scores(counts: DataFrame) -> DataFrame:
    """(gram, score) from (gram, allow, block) counts: millionths of ln p(allow) - ln p(block)."""
    out = counts
    classes = ("allow", "block")
    totals = counts.agg(*[F.sum(c).alias(c) for c in classes]).first()
    if not totals["allow"] or not totals["block"]:
        return counts.select("gram", F.lit(0).cast("long").alias("score"))
    p = {c: F.lit(1.0 / ALPHABET) for c in classes}
    for k in range(ORDER + 1):
        seen = F.substring("gram", ORDER + 1 - k, k + 1)  # k characters of context and the character
        context = F.substring("gram", ORDER + 1 - k, k)
        names = {c: (f"n{k}_{c}", f"c{k}_{c}") for c in classes}
        n = counts.groupBy(seen.alias("seen")).agg(*[F.sum(c).alias(names[c][0]) for c in classes])
        out = out.withColumn("seen", seen).join(n, "seen").drop("seen")
        if k:
            m = counts.groupBy(context.alias("context")).agg(*[F.sum(c).alias(names[c][1]) for c in classes])
            out = out.withColumn("context", context).join(m, "context").drop("context")
        else:
            out = out.withColumns({names[c][1]: F.lit(totals[c]) for c in classes})
        out = out.withColumns({f"p_{c}": (F.col(names[c][0]) + PSEUDO * (F.col(f"p_{c}") if k else p[c])) / (F.col(names[c][1]) + PSEUDO) for c in classes})
        out = out.select("gram", *classes, *[f"p_{c}" for c in classes])
    return out.select("gram", F.round((F.ln("p_allow") - F.ln("p_block")) * 1e6).cast("long").alias("score"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages`` (page_id, url)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    rows = cut(parts.select("page_id", "host", "path", F.concat("host", "path").alias("text"), F.col("r.rule").alias("rule"), F.col("r.verdict").alias("by_rule")), "url_rows")
    is_ = lambda c: F.coalesce(F.col("by_rule") == c, F.lit(False)).cast("long")
    counts = cut(rows.select(F.explode(grams(F.col("text"))).alias("gram"), is_("allow").alias("allow"), is_("block").alias("block"))
                 .groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")), "url_grams")
    model = cut(scores(counts), "url_model")
    model = F.broadcast(model) if model.count() <= BROADCAST_ROWS else model
    texts = rows.select("text").distinct()
    scored = texts.select("text", F.explode(grams(F.col("text"))).alias("gram")).join(model, "gram").groupBy("text").agg(
        (F.sum("score") / 1e6 / F.count(F.lit(1))).alias("score"))
    judged = cut(rows.join(cut(scored, "url_scores"), "text"), "url_judged")
    at = judged.agg(*[f(F.when(F.col("by_rule") == c, F.col("score"))).alias(f"{n}_{c}")
                      for n, f in (("mean", F.avg), ("sd", F.stddev_pop)) for c in ("allow", "block")]).first()
    threshold = 0.0
    if at and at["mean_allow"] is not None and at["mean_block"] is not None:
        spread = at["sd_allow"] + at["sd_block"]
        threshold = (at["mean_allow"] * at["sd_block"] + at["mean_block"] * at["sd_allow"]) / spread if spread else (at["mean_allow"] + at["mean_block"]) / 2
    return judged.select("page_id", "host", "path", "rule",
                         F.coalesce("by_rule", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"),
                         F.round("score", 4).alias("score"))


def sql(rules=RULES) -> str:
    """DuckDB SQL for :func:`judge`."""
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    ends = ORDER + 1
    orders = ""
    for k in range(ends):
        seen, context = f"substr(gram, {ends - k}, {k + 1})", f"substr(gram, {ends - k}, {k})"
        ps = ", ".join(f"(sum({c}) OVER (PARTITION BY {seen}) + {PSEUDO} * p_{c}) / (sum({c}) OVER (PARTITION BY {context}) + {PSEUDO}) AS p_{c}" for c in ("allow", "block"))
        orders += f"o{k + 1} AS (SELECT * REPLACE ({ps}) FROM o{k}),\n"
    return rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r AS (SELECT *, host || path AS text, CASE {rule} END AS rule, CASE {verdict} END AS by_rule FROM u),
g AS (SELECT text, by_rule, unnest(list_transform(range(1, length(text) + 2), lambda i: substr('{"^" * ORDER}' || text || '$', i, {ends}))) AS gram FROM r),
o0 AS (SELECT gram, CAST(count(*) FILTER (by_rule = 'allow') AS DOUBLE) AS allow, CAST(count(*) FILTER (by_rule = 'block') AS DOUBLE) AS block,
    1.0::DOUBLE / {ALPHABET} AS p_allow, 1.0::DOUBLE / {ALPHABET} AS p_block FROM g GROUP BY gram),
{orders}
m AS (SELECT gram, CASE WHEN (SELECT sum(allow) > 0 AND sum(block) > 0 FROM o0) THEN CAST(round((ln(p_allow) - ln(p_block)) * 1e6) AS BIGINT) ELSE 0 END AS score FROM o{ends}),
t AS (
  SELECT text, sum(score) / 1e6 / count(*) AS score
  FROM (SELECT text, unnest(list_transform(range(1, length(text) + 2), lambda i: substr('{"^" * ORDER}' || text || '$', i, {ends}))) AS gram FROM (SELECT DISTINCT text FROM r))
  JOIN m USING (gram) GROUP BY text),
j AS (SELECT * FROM r JOIN t USING (text)),
a AS (
  SELECT avg(score) FILTER (by_rule = 'allow') AS ma, avg(score) FILTER (by_rule = 'block') AS mb,
    stddev_pop(score) FILTER (by_rule = 'allow') AS sa, stddev_pop(score) FILTER (by_rule = 'block') AS sb FROM j),
h AS (SELECT CASE WHEN ma IS NULL OR mb IS NULL THEN 0 WHEN sa + sb = 0 THEN (ma + mb) / 2 ELSE (ma * sb + mb * sa) / (sa + sb) END AS threshold FROM a)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN score >= threshold THEN 'allow' ELSE 'block' END) AS verdict, round(score, 4) AS score
FROM j, h
"""
