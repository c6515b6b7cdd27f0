"""Replies that were paid for are kept, and batches are bounded by bytes."""

import os
import subprocess
import sys
import textwrap

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quizloom.functions.batches import by_bytes
from quizloom.functions.journal import ReplyJournal, asked_digest, digest_of
from quizloom.functions.models import judge_panel, model_grader, text_model
from quizloom.functions.vectors import embedder
from quizloom.operators.asking import ask
from quizloom.plans.generate import generate_replies
from quizloom.plans.panel import Judge, ask_panel

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def calls(path):
    return [line.strip() for line in open(path)] if os.path.exists(path) else []


def note(path, line):
    with open(path, "a") as out:
        out.write(f"{line}\n")


def counting_model(path, fail_at=None, error=None):
    """Replies with the prompt; the ``fail_at``-th call ends the process."""

    def make():
        def reply(prompt, *more):
            note(path, prompt)
            if fail_at is not None and len(calls(path)) == fail_at:
                os._exit(1)
            if error is not None and prompt.endswith(error):
                raise TimeoutError("busy")
            return f" re {prompt} "

        return reply

    return make


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.text(max_size=12)), max_size=30),
    st.integers(1, 40),
    st.one_of(st.none(), st.integers(1, 5)),
)
def test_slices(texts, limit, rows):
    numbers = list(range(len(texts)))
    slices = list(by_bytes((pa.array(texts, pa.string()), pa.array(numbers, pa.int64())), limit, rows))
    assert [t for part, _ in slices for t in part] == texts
    assert [n for _, part in slices for n in part] == numbers
    for part, _ in slices:
        size = sum(len((t or "").encode()) for t in part)
        assert size <= limit or len([t for t in part if t]) == 1
        assert rows is None or len(part) <= rows


def test_long_texts_reach_an_embedder_in_small_calls(spark, tmp_path):
    path = str(tmp_path / "sizes")

    def make():
        def embed(texts):
            note(path, sum(map(len, texts)))
            return [[1.0]] * len(texts)

        return embed

    rows = spark.range(20).select(F.repeat(F.lit("x"), 1 << 20).alias("text")).coalesce(1)
    found = rows.select(embedder(make, batch_bytes=4 << 20)("text").alias("v")).collect()
    assert len(found) == 20
    assert [int(n) for n in calls(path)] == [4 << 20] * 5


def test_digests_are_the_same_on_both_sides(spark):
    rows = [("a", None), (None, "b"), ("é\x1f", ""), ("", "日")]
    df = spark.createDataFrame(rows, "a STRING, b STRING")
    found = df.select("a", "b", asked_digest(F.col("a"), F.col("b")).alias("d")).collect()
    assert all(r.d == digest_of((r.a, r.b)) for r in found)


def prompts(spark, n=60, parts=4):
    return spark.range(n).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt")).repartition(parts)


def test_a_killed_task_costs_only_the_call_in_flight(spark, tmp_path):
    path, log = str(tmp_path / "journal"), str(tmp_path / "calls")
    rows = prompts(spark, parts=1)
    journal = ReplyJournal(path, flush_rows=1)
    with pytest.raises(Exception):
        ask(rows, text_model(counting_model(log, fail_at=25), journal=journal), [F.col("prompt")], "r").collect()
    assert len(calls(log)) == 25
    again = ReplyJournal(path, flush_rows=1)
    found = ask(rows, text_model(counting_model(log), journal=again), [F.col("prompt")], "r").collect()
    assert sorted((r.prompt, r.r.raw, r.r.error) for r in found) == sorted(
        (f"p{i}", f"re p{i}", None) for i in range(60)
    )
    asked = calls(log)
    assert len(asked) == 61 and len(set(asked)) == 60
    # Everything is known by now; also after the small files were put together.
    for _ in range(2):
        later = text_model(counting_model(log), journal=ReplyJournal(path))
        assert ask(rows, later, [F.col("prompt")], "r").filter("r.raw = concat('re ', prompt)").count() == 60
        assert len(calls(log)) == 61
        again.compact(spark)
        assert len(os.listdir(path)) == 1
    assert again.replies(spark).count() == 60


def test_a_task_that_is_run_again_asks_for_the_rest(tmp_path):
    """In a session of its own, where a task may fail: its second attempt goes on."""
    script = textwrap.dedent(
        f"""
        import os, sys
        sys.path[:0] = [{os.getcwd()!r}]
        from pyspark.sql import SparkSession, functions as F
        from quizloom.functions.journal import ReplyJournal
        from quizloom.functions.models import text_model
        log, flag = {str(tmp_path / "calls")!r}, {str(tmp_path / "died")!r}
        def make():
            def reply(prompt):
                open(log, "a").write(prompt + chr(10))
                if prompt == "p40" and not os.path.exists(flag):
                    open(flag, "w").close()
                    os._exit(1)
                return prompt
            return reply
        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
        journal = ReplyJournal({str(tmp_path / "journal")!r}, flush_rows=1)
        rows = spark.range(0, 60, 1, 1).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("p"))
        found = rows.select(text_model(make, journal=journal)(F.col("p")).alias("r")).collect()
        assert [r.r.raw for r in found] == [f"p{{i}}" for i in range(60)]
        """
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    asked = calls(tmp_path / "calls")
    assert len(asked) == 61 and asked.count("p40") == 2


def test_failures_are_asked_again(spark, tmp_path):
    path, log = str(tmp_path / "journal"), str(tmp_path / "calls")
    rows = prompts(spark, 30)
    for error, total in (("7", 30), (None, 33)):
        model = text_model(counting_model(log, error=error), workers=3, journal=ReplyJournal(path))
        found = ask(rows, model, [F.col("prompt")], "r").collect()
        assert len([r for r in found if r.r.error]) == (3 if error else 0)
        assert len(calls(log)) == total


def test_equal_prompts_missing_prompts_and_other_models(spark, tmp_path):
    path, log = str(tmp_path / "journal"), str(tmp_path / "calls")
    rows = spark.createDataFrame([("a",)] * 5 + [(None,), ("b",)], "prompt STRING").coalesce(1)
    for name, total in (("one", 2), ("one", 2), ("two", 4)):
        model = text_model(counting_model(log), name=name, journal=ReplyJournal(path))
        found = ask(rows, model, [F.col("prompt")], "_known").collect()
        assert sorted(str(r["_known"].raw) for r in found) == ["None"] + ["re a"] * 5 + ["re b"]
        assert len(set(calls(log))) == 2 and len(calls(log)) <= total + 8
    assert ReplyJournal(path).replies(spark).count() == 4


def test_generation_with_a_journal(spark, tmp_path):
    path, log = str(tmp_path / "journal"), str(tmp_path / "calls")
    rendered = prompts(spark, 12).select(
        F.col("prompt").alias("taxonomy_id"),
        F.lit(None).cast("string").alias("parser_regex"),
        F.lit(None).cast("int").alias("pattern_groups"),
        F.lit(None).cast("string").alias("problem"),
        "prompt",
    )
    for _ in range(2):
        model = text_model(counting_model(log), journal=ReplyJournal(path))
        assert generate_replies(rendered, model).filter("raw = concat('re ', taxonomy_id)").count() == 12
        assert len(calls(log)) == 12


def test_panel_with_a_journal(spark, tmp_path):
    path, log = str(tmp_path / "journal"), str(tmp_path / "calls")
    rows = [("f.json", "T", i, f"Q{i}. what\n(1) yes\nAnswer: 1") for i in range(20)]
    asked = spark.createDataFrame(rows, "file_path STRING, taxonomy_id STRING, pos INT, q_raw STRING").repartition(3)
    judges = [Judge("a", counting_model(log)), Judge("b", counting_model(log)), Judge("off", counting_model(log), False)]
    plain = ask_panel(asked, judges[:2], "Pick.").collect()
    first = ask_panel(asked, judges[:1], "Pick.", journal=ReplyJournal(path))
    before = len(calls(log))
    both = ask_panel(asked, judges, "Pick.", journal=ReplyJournal(path))
    assert first.count() == 20
    # Only the second judge was still to be asked.
    new = len(calls(log)) - before
    again = ask_panel(asked, judges, "Pick.", journal=ReplyJournal(path))
    assert len(calls(log)) - before == new
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, again.collect())) == sorted(map(tuple, plain))


def test_grader_in_long_and_empty_batches(spark):
    grade = model_grader(lambda: lambda q, a, c: (len(a) > 1, len(q) / 4))
    rows = spark.createDataFrame([("qq", "yes", "c"), ("q", None, "c"), ("", "n", "")], "q STRING, a STRING, c STRING")
    found = rows.select(grade("q", "a", "c").alias("g")).select("g.*").collect()
    assert sorted(map(tuple, found), key=str) == [(False, 0.0, None), (None, None, None), (True, 0.5, None)]
    assert rows.limit(0).select(grade("q", "a", "c").alias("g")).count() == 0
    assert rows.limit(0).select(judge_panel({"m": lambda: str})(F.col("q")).alias("g")).collect() == []
