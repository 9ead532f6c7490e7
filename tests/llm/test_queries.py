"""Registered queries against their SQL, and the pipeline against its stages by brute force."""

import duckdb
import pytest

import corpus_pipeline
from cardvigil.llm import oracles, queries

from .test_decontaminate import brute as brute_benchmark
from .test_native import brute_lines
from .test_near_dedup import brute as brute_near

TABLES = ("documents", "benchmark", "conversations", "pages", "labels")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", list(oracles.ORACLES))
def test_query_equals_its_oracle(spark, duck, sf_dir, rows, name):
    got = queries.QUERIES[name](spark, sf_dir)
    want = duck.sql(oracles.ORACLES[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    expected = want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert [repr(r) for r in rows(got, *columns)] == sorted(map(repr, expected))


def test_one_query_for_each_operator():
    assert sorted(int(n.partition("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(oracles.ORACLES) <= set(queries.QUERIES)


def test_pipeline(spark, duck, sf_dir):
    docs = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    kept = {d for d, k in duck.sql(f"SELECT doc_id, kept FROM ({oracles.QUALITY_RULES})").fetchall() if k}
    docs = [(d, t) for d, t in docs if d in kept]
    docs = [(d, text) for d, _, _, text in brute_lines(docs)]
    found = brute_near(docs)[1]
    docs = [(d, t) for d, t in docs if found[d] == d]
    items = duck.sql("SELECT item_id, text FROM benchmark").fetchall()
    dirty = {d for d, *_, c in brute_benchmark(docs, items) if c}
    docs = {d: t for d, t in docs if d not in dirty}
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in got} == set(docs)
    from .test_bpe import own

    assert all(own().decode(memoryview(bytes(r.ids)).cast("I").tolist()) == docs[r.doc_id] for r in got)
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs, sf_dir).dtypes == docs.dtypes
