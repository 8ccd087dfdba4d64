"""The pipeline's stages, each on its own input, against brute-force versions."""

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from shopflow.llm import mixing, quality, registry, secrets, tokens
from shopflow.llm.common import cut, table

from .test_ngram_join import brute as join_brute
from .test_quality import brute as quality_brute
from .test_tokens import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = [table(spark, SF, "documents")]
    for _, stage in P.STAGES:
        docs.append(cut(stage(spark, docs[-1], SF), "test_stage"))
    return [d.collect() for d in docs]


def test_stages(outputs, spark):
    assert [n.split()[0] for n, _ in P.STAGES] == ["quality", "n-gram", "secret", "mixing", "best-fit"]
    columns = list(outputs[0][0].asDict())
    assert all(list(o[0].asDict()) == columns for o in outputs[:-1])
    # the same rows as run() returns
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, outputs[-1]))


def test_quality_rules(outputs, spark):
    kept = {r.doc_id for r in outputs[1]}
    judged = {r.doc_id: r for r in quality.judge(table(spark, SF, "documents")).collect()}
    for r in outputs[0]:
        n, _, _, _, repeat = quality_brute(r.text)
        if n < 20 or 100 * repeat > 30 * n:
            assert r.doc_id not in kept
        assert (r.doc_id in kept) == judged[r.doc_id].kept


def test_one_of_each_class(outputs):
    classes = join_brute([(r.doc_id, r.text) for r in outputs[1]])
    assert sorted(r.doc_id for r in outputs[2]) == sorted({c for _, c in classes.values()})


def test_masked(outputs):
    assert {r.doc_id: r.text for r in outputs[3]} == {r.doc_id: secrets.masked(r.text) for r in outputs[2]}
    assert all(r.n_chars == len(r.text) for r in outputs[3])
    assert not any(secrets.base_spans(r.text) for r in outputs[3])


def test_mixed(outputs, spark):
    con = duckdb.connect()
    import pyarrow as pa

    documents = pa.Table.from_pylist([r.asDict() for r in outputs[3]])  # noqa: F841
    con.register("documents", documents)
    want = sorted(r[0] for r in con.execute(f"SELECT doc_id FROM ({mixing.sql()}) WHERE selected").fetchall())
    assert sorted(r.doc_id for r in outputs[4]) == want


def test_packed(outputs):
    t = Tokenizer.from_file(tokens.vocabulary_path())
    t.encode_special_tokens = True
    n = check_packing(outputs[5], outputs[4], lambda x: t.encode(x or "", add_special_tokens=False).ids, 1024)
    assert n <= sum(r.length for r in outputs[5]) / 1024 * 1.03 + 2


def test_registered():
    names = set(E.queries())
    assert set(registry.QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert set(registry.SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    cur = con.execute(registry.SQL[name])
    order = [d[0] for d in cur.description]
    assert sorted(order) == sorted(df.columns)
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(key, cur.fetchall())) == sorted(key(tuple(r[c] for c in order)) for r in df.collect())
