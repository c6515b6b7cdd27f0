"""Columns of the input pass through untouched, whatever they are called."""

import os
import sys

import pytest
from helpers import SENTENCE, edge_documents
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

from quizloom.llm import (  # noqa: E402
    exact_dedup,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    secrets,
    text,
    toxicity,
)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Names that the operators use for columns of their own, and odd ones.
NAMES = """
last whole edge ranges row range part start end order leaf _leaf _order tokens docs budget cap w
keep _h _sha _n h norm bucket slot link id _id _key key _drop drop owner batch line lines
_found _new _has new label uid root digest buckets class_id n_copies first best
user_column_0 _ratio cuts shard _shard unit a.b spaced_name
""".split() + ["spaced name", "back`tick"]


def marked(df, names):
    """``df`` with a column of each name whose value is the name and the row's place."""
    place = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return df.select("*", *[F.concat(F.lit(f"{n}:"), place).alias(n) for n in names])


def check(found, names, rows):
    assert len(found) == rows if isinstance(rows, int) else len(found) > 0
    for row in found:
        place = "-" if row["doc_id"] is None else str(row["doc_id"])
        assert all(row[n] == f"{n}:{place}" for n in names)


@pytest.fixture(scope="module")
def documents(spark):
    return marked(edge_documents(spark), NAMES).cache()


def labels(spark, name):
    rows = [(1, 1), (2, 0), (4, 0), (5, 1), (8, 1)]
    return spark.createDataFrame(rows, f"doc_id BIGINT, {name} INT")


OPERATORS = {
    "line_dedup": lambda spark, df: line_dedup.line_dedup(df, batches=2),
    "pii": lambda spark, df: pii.pseudonymise(df, "k"),
    "toxicity": lambda spark, df: toxicity.score_toxicity(df, toxicity.train_toxicity(df, labels(spark, "toxic"))),
    "exact_dedup": lambda spark, df: exact_dedup.mark_copies(df, exact_dedup.build_index(df)),
    "quality": lambda spark, df: quality.judge_quality(df, quality.train_quality(df, labels(spark, "quality"))),
    "secrets": lambda spark, df: secrets.scan_secrets(df),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_keeps_its_columns(spark, documents, name):
    found = OPERATORS[name](spark, documents).collect()
    check(found, NAMES, documents.count())


@pytest.mark.parametrize("name", ["exact_dedup", "near_dedup", "mix"])
def test_rows_that_stay_keep_their_columns(spark, documents, name):
    run = {
        "exact_dedup": exact_dedup.exact_dedup,
        "near_dedup": ngram_join.near_dedup,
        "mix": lambda df: mixing.mix(df),
    }[name]
    found = run(documents)
    check(found.collect(), NAMES, None)
    assert [c for c in found.columns if c in documents.columns] == documents.columns


def test_pairs_and_pieces_read_past_other_columns(spark, documents):
    assert ngram_join.near_duplicates(documents).count() == documents.count()
    assert packing.pack_documents(documents).count() >= documents.count()


def test_hidden_columns_come_back_in_order(spark):
    df = marked(edge_documents(spark), ["b", "kept", "a.b"])
    hidden, show = text.hide(df, "doc_id", "text")
    assert hidden.columns[:2] == ["doc_id", "text"]
    back = show(hidden.withColumn("kept", F.lit(True)), "kept")
    assert back.columns == [c for c in df.columns if c != "kept"] + ["kept"]
    assert show(hidden).collect() == df.collect()


def test_stages_leave_other_columns_alone(spark):
    """Also those named like a result of a stage, and all stages on the awkward rows."""
    names = [*NAMES, "kept", "domain", "epoch", "n_lines", "n_words", "base_failed", "keep_id", "piece"]
    words = " ".join(f"word{i}" for i in range(80))
    rows = [(100 + i, f"{SENTENCE} {words} {i} " + " ".join(f"x{i}y{j}" for j in range(80)), "en", f"src{i}", 5) for i in range(12)]
    rows += [(200, rows[0][1], "en", "src0", 5), (None, rows[3][1] + " tail", None, None, None)]
    docs = marked(edge_documents(spark).union(spark.createDataFrame(rows, edge_documents(spark).schema)), names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF_DIR))
        check(docs.collect(), names, None) if docs.count() else None
        for row in docs.collect():
            assert row["n_chars"] is None or name == "quality_rules" or row["n_chars"] == len(row["text"])
    ids = {r.doc_id for r in docs.collect()}
    # Short and missing texts are gone, and all lines of the copy are.
    assert not ids & {3, 4, 5, 9}
    assert {r.text for r in docs.filter("doc_id = 200").collect()} <= {""}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == ids


def test_runs_leave_no_table_behind(spark):
    before = {t.name for t in spark.catalog.listTables()}
    line_dedup.line_dedup(edge_documents(spark), batches=3).collect()
    assert {t.name for t in spark.catalog.listTables()} == before
