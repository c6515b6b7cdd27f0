"""Each row reaches a model once, and texts do not move to get a number."""

import glob
import json
import os
import sys

import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quizloom.functions.models import model_grader, text_model
from quizloom.functions.vectors import embedder
from quizloom.operators.ranges import cut_ranges, place_in_partition
from quizloom.plans import index as index_plan
from quizloom.plans.rag import evaluate_rag, write_rag_report
from quizloom.sources import corpus as corpus_source
from quizloom.sources import questions as files

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def log(path, lines):
    with open(path, "a") as out:
        out.write("".join(f"{os.getpid()} {line}\n" for line in lines))


def logged(path):
    return [line.split(" ", 1)[1].strip() for line in open(path)] if os.path.exists(path) else []


def counting_embedder(path):
    def make():
        def embed(texts):
            log(path, [t[:9] for t in texts])
            return [[float(len(t)), 1.0] for t in texts]

        return embed

    return embedder(make)


def stored_corpus(spark, tmp_path, n=192, files_=6):
    rows = spark.range(n).select(
        ((F.col("id") * 37) % n).alias("doc_id"),
        F.concat(F.lit("doc"), F.lpad(((F.col("id") * 37) % n).cast("string"), 5, "0"), F.repeat(F.lit(" w"), 25)).alias("text"),
    )
    path = str(tmp_path / "corpus")
    rows.repartition(files_).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("rows_per_file", [16, 1 << 15])
def test_index_build_embeds_each_text_once(spark, tmp_path, monkeypatch, rows_per_file):
    monkeypatch.setattr(index_plan, "ROWS_PER_FILE", rows_per_file)
    monkeypatch.setattr(corpus_source, "ROWS_PER_FILE", rows_per_file)
    corpus, calls, path = stored_corpus(spark, tmp_path), str(tmp_path / "calls"), str(tmp_path / "index")
    found = index_plan.build_index(corpus, path, counting_embedder(calls)).collect()
    assert sorted((r.chunk_id, r.doc_id, r.text[:8]) for r in found) == [
        (i, i, f"doc{i:05d}") for i in range(192)
    ]
    assert sorted(logged(calls)) == [f"doc{i:05d}" for i in range(192)]
    ranges = []
    for file in sorted(glob.glob(f"{path}/*.parquet")):
        ids = pq.read_table(file)["chunk_id"].to_pylist()
        assert ids == sorted(ids)
        ranges += [(ids[0], ids[-1])] if ids else []
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert len(ranges) >= 192 // rows_per_file


def test_index_build_joins_no_texts(spark, tmp_path):
    corpus = stored_corpus(spark, tmp_path)
    planned = index_plan.embed_corpus(corpus, counting_embedder(str(tmp_path / "calls")))
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "BroadcastExchange" not in plan
    # Embedding comes before the only exchange, in the tasks of the scan.
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("ArrowEvalPython")
    assert corpus.rdd.getNumPartitions() > 1


def test_foreign_index_is_written_without_a_second_look(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(corpus_source, "ROWS_PER_FILE", 16)
    calls, path = str(tmp_path / "calls"), str(tmp_path / "index")
    rows = stored_corpus(spark, tmp_path).select(
        F.col("doc_id").alias("chunk_id"), "doc_id", "text", counting_embedder(calls)("text").alias("embedding")
    )
    corpus_source.write_index(rows, path)
    assert sorted(logged(calls)) == [f"doc{i:05d}" for i in range(192)]
    assert corpus_source.read_index(spark, path).count() == 192
    assert len(glob.glob(f"{path}/*.parquet")) == 12


def test_repeated_and_sparse_doc_ids_have_numbers_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(index_plan, "ROWS_PER_FILE", 8)
    ids = [-(10**12), 5, 5, 5, 7, 10**15] + [9] * 40 + list(range(100, 140))
    rows = [(d, f"t{i} " + "w " * 25) for i, d in enumerate(ids)]
    corpus = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    found = index_plan.chunk_corpus(corpus).collect()
    assert sorted(r.chunk_id for r in found) == list(range(len(ids)))
    assert [d for _, d in sorted((r.chunk_id, r.doc_id) for r in found)] == sorted(ids)
    narrow = index_plan.chunk_ids(corpus).collect()
    assert sorted((r.chunk_id, r.doc_id) for r in narrow) == sorted((r.chunk_id, r.doc_id) for r in found)


@pytest.mark.parametrize("rows_per_range", [1, 10, 1000])
def test_ranges_of_any_key(spark, rows_per_range):
    keys = [(None, 1), ("a", None), ("a", 3), ("b\"{", 2), ("é", 1), ("日", 5)] + [("hot", 7)] * 50
    keys += [(f"f{i % 7}", i) for i in range(200)]
    rows = spark.createDataFrame(keys, "name STRING, pos INT").repartition(4)
    ranges = cut_ranges(rows, ["name", "pos"], rows_per_range)
    assert sum(ranges.weights) == len(keys)
    placed = ranges.gather(rows, "r").withColumn("n", ranges.start(F.col("r")) + place_in_partition())
    found = [(r.name, r.pos) for r in sorted(placed.collect(), key=lambda r: r.n)]
    expected = [(r.name, r.pos) for r in rows.orderBy("name", "pos").collect()]
    assert found == expected
    assert sorted(r.n for r in placed.collect()) == list(range(len(keys)))


def counting_grader(path):
    def make():
        def grade(question, answer, context):
            log(path, [question])
            return True, 0.5

        return grade

    return model_grader(make)


@pytest.mark.parametrize("rows_per_file", [5, 1 << 15])
def test_graders_are_called_once_and_files_are_in_order(spark, tmp_path, monkeypatch, rows_per_file):
    monkeypatch.setattr(files, "ROWS_PER_FILE", rows_per_file)
    stored = stored_corpus(spark, tmp_path, 40)
    index = index_plan.build_index(stored, str(tmp_path / "index"), counting_embedder(str(tmp_path / "e")))
    rows = [(f"f{i % 3}.json", "T", i, f"Q{i}. what\n(1) yes\nAnswer: 1") for i in range(36)]
    asked = spark.createDataFrame(rows, "file_path STRING, taxonomy_id STRING, pos INT, q_raw STRING").repartition(5)
    one, two = str(tmp_path / "faithful"), str(tmp_path / "relevant")
    graded = evaluate_rag(
        asked,
        index,
        counting_embedder(str(tmp_path / "q")),
        text_model(lambda: lambda question, context: "yes"),
        counting_grader(one),
        counting_grader(two),
    )
    write_rag_report(graded, str(tmp_path / "report"))
    expected = sorted(f"Q{i}. what" for i in range(36))
    assert sorted(logged(one)) == sorted(logged(two)) == expected
    # A later use of the table asks nobody again.
    assert graded.filter("is_faithful").count() == 36
    assert len(logged(one)) == 36
    lines = []
    for file in sorted(glob.glob(str(tmp_path / "report" / "*.json"))):
        lines += [json.loads(line) for line in open(file)]
    order = [(line["file_path"], line["pos"]) for line in lines]
    assert order == sorted((f"f{i % 3}.json", i) for i in range(36))
