"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopflow.llm import (
    ann, decontaminate, fill_middle, html_crf, licenses, mixing, ngram_join, packing, prefix_trie, quality, secrets, token_files, url_filter,
)
from shopflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and language-model verdicts of every url of ``pages``."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of ``documents``, read back as digests."""
    return token_files.token_table(table(spark, sf_dir, "documents"))


def op4_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base quality statistics and robust outlier verdicts of all ``documents``."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op5_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for each hundredth row of ``embeddings``."""
    return ann.search(table(spark, sf_dir, "embeddings"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of all ``documents`` linked by a Jaccard similarity of 5-word shingles of at least 3/4."""
    return ngram_join.classes(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 1024 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every row of ``pages``."""
    return html_crf.extract(table(spark, sf_dir, "pages"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every whole text of ``documents``."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weights, sampling probabilities and decisions of all ``documents``."""
    return mixing.weigh(table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle forms of all ``documents``, as checksums with the texts rebuilt from them."""
    return fill_middle.digests(fill_middle.transform(table(spark, sf_dir, "documents")))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of ``benchmark`` found in every whole text of ``documents``."""
    return decontaminate.report(decontaminate.mark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt ``conversations``."""
    return prefix_trie.report(prefix_trie.trie(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_secret_scan, op2_url_filter, op3_token_files, op4_quality_outliers, op5_learned_partitions,
    op6_ngram_jaccard, op7_best_fit_packing, op8_html_text, op9_license_scan, op10_source_mixing,
    op11_fill_middle, op12_decontamination, op13_prefix_trie)}
SQL: dict[str, str] = {
    "op2_url_filter": url_filter.sql(),
    "op10_source_mixing": mixing.sql(),
    "op11_fill_middle": fill_middle.SQL,
    "op12_decontamination": decontaminate.SQL,
    "op13_prefix_trie": prefix_trie.SQL,
    "op6_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON r.v = e.a WHERE r.c < e.b)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT v, min(c) AS c FROM r GROUP BY v) m ON m.v = w.doc_id
""",
}
