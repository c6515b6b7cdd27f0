"""The registered queries on the smallest driver tables, and the pipeline stage by stage."""

import os

import pytest
from helpers import edge_documents

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
if not os.path.isdir(SF_DIR):
    pytest.skip("no driver tables", allow_module_level=True)

import corpus_pipeline  # noqa: E402
from quizloom.llm.queries import ORACLE, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


@pytest.mark.parametrize("name", ORACLE)
def test_query_against_sql(spark, duck, name):
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    expected = sorted(result.fetchall(), key=repr)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == expected


@pytest.mark.parametrize("name", ["op2_pii", "op4_toxicity", "op6_quality", "op9_secrets", "op10_ngram_join"])
def test_one_row_per_document(spark, duck, name):
    ids = sorted(r.doc_id for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect())
    assert ids == [i for (i,) in duck.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = _stored(stage(spark, docs, SF_DIR))
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert before > counts[0] == counts[1] > counts[2] > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, SF_DIR).count() == pieces.count()


def _stored(df):
    from quizloom.operators.storage import materialise

    return materialise(df)


def test_stages_on_edge_rows(spark):
    docs = edge_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).count()
        stage(spark, docs.limit(0), SF_DIR).count()
