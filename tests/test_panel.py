import json
import sys

import pytest
from pyspark import cloudpickle

from quizloom import schemas
from quizloom.operators import panel
from quizloom.plans.panel import Judge, ask_panel, evaluate_panel, grade_responses

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SET = "f.json"
RAW = [
    "Q1. a\n(1) x\n(2) y\nAnswer: 2",
    "Q2. b\n(1) x\n(2) y\nAnswer: A",
    "Q3. no key",
    "Q1. a\n(1) x\n(2) y\nAnswer: 2",
]


@pytest.fixture
def questions(spark):
    rows = [(SET, "T", i, q) for i, q in enumerate(RAW)]
    return spark.createDataFrame(rows, schemas.QUESTION)


def always_two():
    return lambda prompt: " Answer: 2 "


def failing():
    def ask(prompt):
        raise RuntimeError("down")

    return ask


def quiet():
    return lambda prompt: "no idea"


def reads_prompt():
    return lambda prompt: "Answer: 1" if "Q2" in prompt and "Answer: A" not in prompt else "Answer: 9"


JUDGES = [
    Judge("two", always_two),
    Judge("fails", failing),
    Judge("quiet", quiet),
    Judge("reader", reads_prompt),
    Judge("off", always_two, enabled=False),
]


def test_panel_end_to_end(spark, questions, tmp_path):
    result = evaluate_panel(questions, JUDGES, "Choose.", partitions=3)
    assert result.responses.count() == 3 * 4
    raws = {(r["pos"], r["model"]): r["raw"] for r in result.responses.collect()}
    assert raws[0, "two"] == "Answer: 2"
    assert raws[0, "fails"] == "Error: RuntimeError: down"

    report = {r["pos"]: r for r in result.per_question().collect()}
    assert set(report) == {0, 1, 3}
    counts = ("correct_models", "incorrect_models", "unanswered_models", "total_models")
    assert [report[0][c] for c in counts] == [1, 0, 3, 4]
    assert [report[1][c] for c in counts] == [1, 1, 2, 4]
    assert (report[0]["correct_ratio"], report[0]["difficulty_tag"]) == (0.25, "hard")
    assert report[0]["question_raw"] == report[3]["question_raw"] == RAW[0]

    result.write(str(tmp_path / "out"), debug=True)
    (summary,) = [f.read_text() for f in (tmp_path / "out" / "summary").glob("part-*")]
    document = json.loads(summary)
    assert document["total_questions"] == 4
    assert document["models"]["two"] == {
        "correct": 2,
        "incorrect": 1,
        "unanswered": 0,
        "total": 3,
        "accuracy": 2 / 3,
    }
    assert document["models"]["quiet"]["accuracy"] == 0
    lines = {r["model"]: r["line"] for r in result.lines().collect()}
    assert lines["two"] == "  two                     acc=66.67%  (C:2 I:1 U:0)"

    debug = {r["pos"]: r for r in spark.read.json(str(tmp_path / "out" / "debug")).collect()}
    assert debug[2]["error"] == panel.MISSING_KEY and debug[2]["models"] is None
    assert debug[1]["models"]["two"]["answer"] == 2
    assert debug[1]["models"]["two"]["correct"] == 1
    assert debug[1]["models"]["fails"]["raw"] == "Error: RuntimeError: down"


def test_models_and_questions_without_responses(spark, questions):
    none = spark.createDataFrame([], schemas.RESPONSE)
    result = grade_responses(questions, none, ["idle"])
    (row,) = result.summary().collect()
    assert row.asDict() == {
        "model": "idle",
        "correct": 0,
        "incorrect": 0,
        "unanswered": 0,
        "total": 0,
        "accuracy": 0.0,
    }
    report = result.per_question().collect()
    assert {(r["total_models"], r["correct_ratio"], r["difficulty_tag"]) for r in report} == {
        (0, 0.0, "very_hard")
    }
    assert ask_panel(questions, [], "Choose.").count() == 0


def test_no_questions(spark):
    empty = spark.createDataFrame([], schemas.QUESTION)
    result = grade_responses(empty, spark.createDataFrame([], schemas.RESPONSE), ["m"])
    document = json.loads(result.document().first()["value"])
    assert document["total_questions"] == 0 and document["models"]["m"]["total"] == 0


def test_one_client_per_model_and_task(spark, questions, tmp_path):
    log = str(tmp_path / "clients")

    def make():
        with open(log, "a") as f:
            f.write("x")
        return lambda prompt: "Answer: 1"

    ask_panel(questions, [Judge("m", make)], "Choose.", workers=2, partitions=1)
    assert len((tmp_path / "clients").read_text()) == 1


def test_partitioning_does_not_matter(spark, questions):
    responses = ask_panel(questions, JUDGES, "Choose.")
    reports = {
        tuple(sorted(map(tuple, grade_responses(
            questions.repartition(n), responses.repartition(n), ["two", "reader"]
        ).per_question().collect())))
        for n in (1, 4, 16)
    }
    assert len(reports) == 1
