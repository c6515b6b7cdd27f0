import csv
import glob
import gzip
import json
import sys
import tracemalloc
import warnings

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.functions.models import model_grader, text_model
from quizloom.functions.vectors import embedder, hash_embedder
from quizloom.operators.upsert import write_store
from quizloom.functions.patterns import to_java
from quizloom.operators import bundles
from quizloom.operators.bundles import with_text
from quizloom.plans import generate, review
from quizloom.operators.storage import child_folders, shared_folder
from quizloom.plans.benchmark import build_benchmark
from quizloom.plans.index import build_index, embed_corpus
from quizloom.plans.rag import evaluate_rag, question_stems
from quizloom.plans.retrieval import build_bundles, retrieve
from quizloom.sources import questions as files
from quizloom.sources.corpus import read_chunks, read_corpus, read_index, read_vectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EMBED = hash_embedder(32)


def document(word, n=20):
    return " ".join([word] * n)


TEXTS = [document("apple"), "too short", None, document("pear"), document("apple pear", 10), document("apple", 19)]


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), schemas.CORPUS)


def test_index(spark, corpus, tmp_path):
    path = str(tmp_path / "index")
    index = build_index(corpus, path, EMBED)
    rows = sorted((r["chunk_id"], r["doc_id"]) for r in index.collect())
    assert rows == [(0, 0), (1, 3), (2, 4)]
    assert {len(r["embedding"]) for r in index.collect()} == {32}
    assert build_index(corpus.limit(1), path, EMBED).count() == 3
    assert read_vectors(spark, path).columns == ["chunk_id", "embedding"]
    assert read_index(spark, path).count() == 3


def test_embedder_gets_only_present_texts(spark):
    def make():
        def embed(texts):
            assert None not in texts and len(texts) <= 2
            return [[len(t), 1.0] for t in texts]

        return embed

    rows = spark.createDataFrame([("abc",), (None,), ("",), ("ab",)], "t STRING").coalesce(1)
    found = [r[0] for r in rows.select(embedder(make, batch_size=2)(F.col("t"))).collect()]
    assert found == [[3.0, 1.0], None, [0.0, 1.0], [2.0, 1.0]]


def test_retrieve_and_bundles(spark, corpus):
    index = embed_corpus(corpus, EMBED)
    queries = spark.createDataFrame([("q", "pear"), ("r", "apple")], "query_id STRING, text STRING")
    hits = retrieve(queries, index, EMBED, k=2).collect()
    assert {(h["query_id"], h["rank"], h["doc_id"]) for h in hits} == {
        ("q", 1, 3),
        ("q", 2, 4),
        ("r", 1, 0),
        ("r", 2, 4),
    }
    leaves = spark.createDataFrame(
        [("D.pear", "pear", "E", ["p"]), ("D.apple", "apple", "H", None)], schemas.LEAF
    )
    bundles = {b["taxonomy_id"]: b for b in build_bundles(leaves, index, EMBED, k=9).collect()}
    assert bundles["D.pear"]["query_terms"] == ["pear", "p"]
    assert [p["doc_id"] for p in bundles["D.apple"]["passages"]] == [0, 4, 3]
    assert "difficulty" not in bundles["D.apple"]
    empty = build_bundles(leaves, index.limit(0), EMBED).collect()
    assert [b["passages"] for b in empty] == [[], []]


def test_texts_of_the_winners(spark, tmp_path):
    path = str(tmp_path / "chunks")
    rows = spark.range(100).select(
        F.col("id").alias("chunk_id"), F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")
    )
    rows.repartitionByRange(20, "chunk_id").write.parquet(path)
    chunks = spark.read.parquet(path)
    hits = spark.createDataFrame([("q", 3, 1), ("q", 97, 2), ("r", 3, 1)], "query_id STRING, chunk_id LONG, rank INT")
    found = with_text(hits, chunks)
    assert {(r["query_id"], r["text"]) for r in found.collect()} == {("q", "3"), ("q", "97"), ("r", "3")}
    assert with_text(hits.limit(0), chunks).count() == 0
    many = with_text(hits, chunks, id_bytes=16)
    assert sorted(map(str, many.select(*found.columns).collect())) == sorted(
        map(str, found.collect())
    )


def scans(plan):
    """Scans of a table with texts in an executed plan."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return scans(plan.executedPlan())
    if "QueryStage" in name:
        return scans(plan.plan())
    if name.startswith("Scan parquet"):
        return int("text#" in plan.toString())
    children = plan.children()
    return sum(scans(children.apply(i)) for i in range(children.size()))


@pytest.mark.parametrize("per_file", [1, 1 << 10])
def test_winners_as_bitmaps(spark, tmp_path, monkeypatch, per_file):
    monkeypatch.setattr(bundles, "BITMAPS_PER_FILE", per_file)
    ids = [0, 1, 7, 8, 32_766, 32_767, 32_768, 65_535, 65_536, 10**6, 2**40]
    rows = [(i + d, i, f"text {i + d}") for i in ids for d in (0, 1, 2) if i + d not in ids or d == 0]
    path = str(tmp_path / "chunks")
    spark.createDataFrame(rows, "chunk_id LONG, doc_id LONG, text STRING").write.parquet(path)
    hits = spark.createDataFrame([(f"q{q}", i) for i in ids for q in range(3)], "query_id STRING, chunk_id LONG")
    found = with_text(hits, spark.read.parquet(path), id_bytes=8)
    got = sorted((r["query_id"], r["chunk_id"], r["text"]) for r in found.collect())
    assert got == sorted((f"q{q}", i, f"text {i}") for i in ids for q in range(3))
    # One scan of the texts, however many winners.
    assert scans(found._jdf.queryExecution().executedPlan()) == 1


def generator():
    def reply(prompt):
        if "apple" in prompt.split("|")[0]:
            raise TimeoutError("busy")
        if "plum" in prompt.split("|")[0]:
            return "Error: 500"
        return f" {prompt[:6]}\nQ1. a\n(1) x\nAnswer: 1\nQ2. b\n(1) y\nAnswer: 1\n"

    return reply


def test_whole_run_and_resume(spark, corpus, tmp_path):
    leaves = [("D", "C", t, "E", f"D.C.{t}") for t in ("pear", "apple", "plum")]
    leaf_store, prompt_store = str(tmp_path / "leaves"), str(tmp_path / "prompts")
    empty = spark.createDataFrame([], schemas.STORED_LEAF)
    args = {
        "corpus": corpus,
        "folder": str(tmp_path / "run"),
        "leaf_store": leaf_store,
        "prompt_store": prompt_store,
        "prompt_id": "p",
        "embed": EMBED,
        "generator": text_model(generator),
    }
    with pytest.raises(ValueError, match="no taxonomy leaves"):
        build_benchmark(spark, **args)
    write_store(spark.createDataFrame(leaves, empty.schema), leaf_store)
    with pytest.raises(ValueError, match="no prompt_id 'p'"):
        build_benchmark(spark, **args)
    template = "{leaf_label} {diff_tag} {n} {options}|{context}"
    prompts = [("p", None, None, template, None, "1.0", None)]
    write_store(spark.createDataFrame(prompts, schemas.PROMPT), prompt_store)

    before = set(child_folders(spark, shared_folder(spark)))
    assert build_benchmark(spark, **args) == {"success": 1, "skipped": 0, "failed": 2}
    assert set(child_folders(spark, shared_folder(spark))) == before
    args.update(generator=text_model(lambda: lambda prompt: "none"), batches=3)
    again = build_benchmark(spark, **args)
    assert again == {"success": 2, "skipped": 1, "failed": 0}
    sets = files.read_question_sets(spark, f"{args['folder']}/questions")
    found = {r["taxonomy_id"]: r["mcqs"] for r in sets.collect()}
    assert found["D.C.pear"] == ["Q1. a\n(1) x\nAnswer: 1", "Q2. b\n(1) y\nAnswer: 1"]
    assert found["D.C.apple"] == found["D.C.plum"] == []


def test_template_problems(spark):
    bundles = spark.createDataFrame(
        [("A.b.c", "one"), ("A.b.d", "two"), ("A.b.e", "bad"), ("A.b.f", "open"), ("A.b.g", "pair")],
        "taxonomy_id STRING, prompt_id STRING",
    ).withColumn("passages", F.array().cast(schemas.BUNDLE["passages"].dataType))
    prompts = spark.createDataFrame(
        [
            ("one", "", "", "{leaf_label}", r"Q\d+", "1.0", None),
            ("bad", "", "", "{nope}", None, "1.0", None),
            ("open", "", "", "{leaf_label}", r"Q(\d+", "v2", None),
            ("pair", "", "", "{leaf_label}", r"(Q)(?P<no>\d{,3})(?=[[ ]|\Z)", None, None),
        ],
        schemas.PROMPT,
    )
    done = spark.createDataFrame([], schemas.QUESTION_SET)
    echo = text_model(lambda: lambda prompt: f"Q1 {prompt} Q22")
    sets, status = generate.generate_questions(bundles, prompts, echo, done)
    assert sorted((r["taxonomy_id"], r["mcqs"]) for r in sets.collect()) == [
        ("A.b.c", ["Q1", "Q22"]),
        ("A.b.g", ['["Q","1"]', '["Q","22"]']),
    ]
    lines = {r["line"] for r in generate.status_lines(status).collect()}
    assert lines == {
        "Success: A.b.c",
        "Failed: A.b.d with error: unknown prompt two",
        "Failed: A.b.e with error: unknown fields {nope}",
        "Failed: A.b.f with error: unusable pattern: missing ), unterminated subpattern at position 1",
        "Success: A.b.g",
    }


@pytest.mark.parametrize(
    "pattern,text",
    [
        (r"(?P<a>x+)-(?P=a)", "xx-xx x-xx"),
        (r"a{,2}b\Z", "aaab b"),
        (r"[[a]+", "[a[ b"),
        (r"[]a&&b]+", "a&]b c"),
        (r"[^]x]+", "ab]x"),
        (r"[a\]&~|]+(?#note)c", "a]&~|c"),
        (r"\[\d\]", "[1] [2]"),
    ],
)
def test_patterns_mean_the_same(spark, pattern, text):
    import re

    java, groups = to_java(pattern)
    row = spark.createDataFrame([(text, java)], "t STRING, p STRING")
    found = row.select(F.regexp_extract_all("t", F.concat(F.lit("(?sdU)"), "p"), F.lit(0))).first()[0]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", FutureWarning)
        expected = [m.group() for m in re.finditer(pattern, text, re.DOTALL)]
    assert found == expected
    assert groups == re.compile(pattern).groups


@pytest.mark.parametrize("at_once", [1, 2, 3, 100])
def test_patterns_are_compiled_in_parts(spark, monkeypatch, at_once):
    monkeypatch.setattr(generate, "PATTERNS_AT_ONCE", at_once)
    rows = [("a", r"Q\d+"), ("b", "(x)(y)"), ("c", "(open"), ("d", None), ("e", r"Q\d+")]
    df = spark.createDataFrame(rows, "prompt_id STRING, parser_regex STRING")
    found = {r.prompt_id: r for r in generate.with_runnable_patterns(df).collect()}
    assert {k: r.pattern_groups for k, r in found.items()} == {"a": 0, "b": 2, "c": None, "d": None, "e": 0}
    assert [k for k, r in found.items() if r.pattern_problem] == ["c"]


def test_patterns_without_a_form():
    for pattern in ("(", "(a)(?(1)b|c)"):
        with pytest.raises(ValueError):
            to_java(pattern)


def test_sets_without_an_id(spark, tmp_path):
    """Their questions keep a key of their own, and the panel finds their replies."""
    (tmp_path / "a.json").write_text(
        '{"mcqs": ["Q1. a\\n(1) x\\nAnswer: 1", "Q2. b\\n(1) x\\nAnswer: 1"]}\n'
        '{"mcqs": ["Q3. c\\n(1) x\\nAnswer: 1"]}\n{"taxonomy_id": "T", "mcqs": ["Q4. d\\nAnswer: 1"]}\n'
    )
    q = files.explode_questions(files.read_question_sets(spark, str(tmp_path)))
    keys = {(r["file_path"], r["pos"]) for r in q.collect()}
    assert len(keys) == 4 and all(path is not None for path, _ in keys)


def questions_of(spark, texts):
    rows = [(f"f{i % 2}.json", "T", i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schemas.QUESTION)


def test_stems_are_limited_before_they_are_filtered(spark):
    q = questions_of(spark, ["Q1. a\n(1) x", "none", "none", "Q1. d\n(1) x"])
    assert [r["query"] for r in question_stems(q, 2).collect()] == ["Q1. a"]
    assert {r["query"] for r in question_stems(q, None).collect()} == {"Q1. a", "Q1. d"}


def test_rag(spark, corpus):
    q = questions_of(spark, ["pear\n(1) x", "apple plum\n(1) x", "skip"])
    index = embed_corpus(corpus, EMBED)
    answerer = text_model(lambda: lambda question, context: f"{question} {len(context.split())}")
    graded = evaluate_rag(q, index, EMBED, answerer, k=1).collect()
    by_query = {r["query"]: r for r in graded}
    assert by_query["pear"]["response"] == "pear 20"
    assert by_query["pear"]["faithfulness_score"] == 0.5 and by_query["pear"]["is_faithful"]
    assert by_query["apple plum"]["relevancy_score"] == 1.0
    assert not by_query["apple plum"]["is_faithful"]

    def make():
        def grade(question, answer, context):
            if "plum" in question:
                raise ValueError("no grade")
            return True, 0.25

        return grade

    own = evaluate_rag(q, index, EMBED, answerer, model_grader(make), model_grader(make), k=1)
    scores = {r["query"]: (r["is_faithful"], r["relevancy_score"]) for r in own.collect()}
    assert scores == {"pear": (True, 0.25), "apple plum": (None, None)}


def test_review_sheet_csv(spark, tmp_path):
    q = questions_of(
        spark,
        [
            'Q1. say "hi",\n now \n(1) a, b\n(2) "c"\n(3)  \nAnswer: 2',
            "Q2. b\n(1) only\nAnswer: 7",
            "Q3. letters\n(1) a\nAnswer: B",
            "Q4. d\n(1) x\n(2) y\nAnswer: 1",
        ],
    )
    orders = set()
    for parts in (1, 4, 16):
        sheet = review.review_sheet(q.repartition(parts), seed=3)
        path = str(tmp_path / f"sheet{parts}")
        files.write_sheet(sheet.coalesce(1), path)
        (name,) = glob.glob(f"{path}/part-*")
        with open(name, encoding="utf-8", newline="") as f:
            text = f.read()
        assert text.endswith("\r\n")
        orders.add(tuple(map(tuple, csv.reader(text.splitlines(keepends=True)))))
    (rows,) = orders
    header = ("Question Text", "Option 1", "Option 2", "Option 3", "Answer Text", "Answer Number")
    assert rows[0] == header
    assert set(rows[1:]) == {
        ('say "hi",\n now', "a, b", '"c"', "", '"c"', "2"),
        ("b", "only", "", "", "Error: Invalid Answer Index", "7"),
        ("d", "x", "y", "", "x", "1"),
    }
    empty = review.review_sheet(q.limit(0)).collect()
    assert [r["line"] for r in empty] == ["Question Text,Answer Text,Answer Number"]


def test_a_very_wide_question_costs_data_not_schema(spark):
    stray = "\n".join(f"stray {i}" for i in range(3000))
    q = questions_of(spark, [f"Q1. a\n(1) x\n{stray}\nAnswer: 1", "Q2. b\n(1) x\nAnswer: 1"])
    sheet = review.review_sheet(q)
    assert sheet.columns == ["line"]
    assert {len(r["line"].split(",")) for r in sheet.collect()} == {3004}


def test_question_files(spark, tmp_path):
    folder = tmp_path / "q"
    folder.mkdir()
    (folder / "b.json").write_text(json.dumps({"taxonomy_id": "T", "mcqs": ["é", "é"]}, indent=2))
    (folder / "a.json").write_text(json.dumps({"mcqs": ["x"]}))
    (folder / "c.json").write_text(json.dumps({"taxonomy_id": "none"}))
    (folder / "d.txt").write_text("not read")
    sets = files.read_question_sets(spark, str(folder), file_per_row=True)
    rows = [tuple(r) for r in files.explode_questions(sets).orderBy("file_path", "pos").collect()]
    assert [(t, p, q) for _, t, p, q in rows] == [("a", 0, "x"), ("T", 0, "é"), ("T", 1, "é")]
    assert rows[0][0].endswith("/a.json")
    (folder / "e.json").write_text("{broken")
    with pytest.raises(Exception, match="unreadable JSON"):
        files.read_question_sets(spark, str(folder), file_per_row=True).collect()
    kept = files.read_question_sets(spark, str(folder), file_per_row=True, skip_bad=True)
    assert kept.count() == 3


def test_bundle_files(spark, tmp_path):
    path = str(tmp_path / "b")
    passage = (1, 2, "t", 0.5)
    rows = [("A", ["a"], [passage], None), ("B", ["b"], [], None)]
    files.write_json(spark.createDataFrame(rows, schemas.BUNDLE), path)
    found = {r["taxonomy_id"]: r for r in files.read_bundles(spark, path).collect()}
    assert tuple(found["A"]["passages"][0]) == passage and found["B"]["passages"] == []


def test_corpus_and_chunk_sources(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.createDataFrame([("one", 5), ("two", 6)], "Text STRING, id INT").coalesce(1).write.parquet(path)
    by_position = sorted(map(tuple, read_corpus(spark, path).collect()))
    assert by_position == [(0, "one"), (1, "two")]
    by_id = read_corpus(spark, path, id_col="id")
    assert sorted(map(tuple, by_id.collect())) == [(5, "one"), (6, "two")]
    assert read_corpus(spark, path, text_col="id").filter("text IS NOT NULL").count() == 0
    meta = tmp_path / "meta.jsonl.gz"
    with gzip.open(meta, "wt") as f:
        f.write(json.dumps({"chunk_id": 0, "doc_id": 4, "text": "t"}) + "\n")
    assert [tuple(r) for r in read_chunks(spark, str(meta)).collect()] == [(0, 4, "t")]


def test_hash_embedder_forgets_words():
    """What a task holds does not grow with the number of different words."""
    texts = (pa.array([" ".join(f"word{b}x{i}y{j}" for j in range(100)) for i in range(100)]) for b in range(30))
    tracemalloc.start()
    try:
        for vectors in hash_embedder(8).func(texts):
            assert len(vectors) == 100
            del vectors
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 30 << 20
