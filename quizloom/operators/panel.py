"""Grading of a judge panel: responses against answer keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.functions.mcq import (
    accuracy,
    answer_key,
    difficulty_tag,
    outcome,
    panel_choice,
    report_line,
)
from quizloom.operators.columns import with_computed

KEY = ["file_path", "pos"]
MISSING_KEY = "Answer tag missing."


def with_keys(questions: DataFrame) -> DataFrame:
    """Questions with their answer key; NULL marks a question that is not graded."""
    return with_computed(questions, "correct", answer_key(F.col("q_raw")))


def gradable(keyed: DataFrame) -> DataFrame:
    return keyed.filter(F.col("correct").isNotNull())


def _choices(responses: DataFrame) -> DataFrame:
    """Answers reduced to a number before anything is shuffled."""
    return responses.select(
        *KEY,
        "model",
        panel_choice(F.col("raw")).alias("choice"),
    )


def graded(questions: DataFrame, responses: DataFrame) -> DataFrame:
    """``file_path, pos, model, correct, choice, outcome`` per response.

    Only narrow columns travel: response texts become numbers first and question
    texts stay behind.
    """
    keyed = gradable(with_keys(questions)).select(*KEY, "correct")
    result = outcome(F.col("choice"), F.col("correct"))
    return _choices(responses).join(keyed, KEY).withColumn("outcome", result)


def _tallies() -> list[Column]:
    names = ("correct", "incorrect", "unanswered")
    return [F.count_if(F.col("outcome") == n).alias(f"n_{n}") for n in names]


def question_report(questions: DataFrame, responses: DataFrame) -> DataFrame:
    """Outcome counts, ratio and difficulty of every gradable question.

    Responses are added up per question and chosen option before the join, which is
    what lets the join and the report share one shuffle of the questions.
    """
    counts = (
        _choices(responses)
        .groupBy(*KEY)
        .agg(
            F.count("*").alias("total_models"),
            F.count_if(F.col("choice").isNull()).alias("unanswered_models"),
            *[F.count_if(F.col("choice") == i).alias(f"_c{i}") for i in range(1, 9)],
        )
    )
    zero = F.lit(0).cast("bigint")
    per_choice = F.array(*[F.col(f"_c{i}") for i in range(1, 9)])
    right = F.coalesce(F.get(per_choice, F.col("correct") - 1), zero)
    return (
        gradable(with_keys(questions))
        .join(counts, KEY, "left")
        .withColumn("correct_models", right)
        .withColumn("unanswered_models", F.coalesce("unanswered_models", zero))
        .withColumn("total_models", F.coalesce("total_models", zero))
        .withColumn("correct_ratio", accuracy(F.col("correct_models"), F.col("total_models")))
        .select(
            *KEY,
            "taxonomy_id",
            F.col("q_raw").alias("question_raw"),
            "correct",
            "correct_models",
            (
                F.col("total_models") - F.col("correct_models") - F.col("unanswered_models")
            ).alias("incorrect_models"),
            "unanswered_models",
            "total_models",
            "correct_ratio",
            difficulty_tag(F.col("correct_ratio")).alias("difficulty_tag"),
        )
    )


def model_summary(questions: DataFrame, responses: DataFrame, models: list[str]) -> DataFrame:
    """Outcome counts and accuracy per panel model, models without questions too."""
    spark = questions.sparkSession
    panel = spark.createDataFrame([(m,) for m in models], "model STRING")
    stats = (
        graded(questions, responses)
        .groupBy("model")
        .agg(*_tallies(), F.count("*").alias("n_total"))
    )
    zero = F.lit(0).cast("bigint")
    counts = [
        F.coalesce(F.col(f"n_{n}"), zero).alias(n)
        for n in ("correct", "incorrect", "unanswered", "total")
    ]
    return (
        panel.join(stats, "model", "left")
        .select("model", *counts)
        .withColumn("accuracy", accuracy(F.col("correct"), F.col("total")))
    )


def report_lines(summary: DataFrame) -> DataFrame:
    names = ("model", "accuracy", "correct", "incorrect", "unanswered")
    return summary.select("model", report_line(*[F.col(n) for n in names]).alias("line"))


def summary_document(questions: DataFrame, summary: DataFrame) -> DataFrame:
    """The summary as one JSON object: ``total_questions`` and a map of models.

    ``total_questions`` counts every question found, gradable or not. The summary has
    one row per panel model, so collecting it into a map is bounded by the panel.
    """
    counts = ("correct", "incorrect", "unanswered", "total", "accuracy")
    models = summary.select(
        F.lit(0).cast("bigint").alias("n"), F.struct("model", F.struct(*counts)).alias("m")
    )
    found = questions.select(
        F.lit(1).cast("bigint").alias("n"), F.lit(None).cast(models.schema["m"].dataType).alias("m")
    )
    document = F.struct(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_questions"),
        F.map_from_entries(F.sort_array(F.collect_list("m"))).alias("models"),
    )
    return found.unionByName(models).agg(F.to_json(document).alias("value"))


def debug_rows(questions: DataFrame, responses: DataFrame) -> DataFrame:
    """Per question: every model's answer and raw text, or why it was not graded.

    A question's map holds one entry per panel model.
    """
    answers = (
        responses.select(*KEY, "model", "raw", panel_choice(F.col("raw")).alias("choice"))
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(F.struct("model", "choice", "raw"))).alias("_answers"))
    )
    keyed = with_keys(questions)
    correct = F.col("correct")
    by_model = F.map_from_entries(
        F.transform(
            "_answers",
            lambda a: F.struct(
                a["model"],
                F.struct(
                    a["choice"].alias("answer"),
                    correct.alias("correct"),
                    a["raw"].alias("raw"),
                    F.lit(None).cast("string").alias("error"),
                ),
            ),
        )
    )
    return keyed.join(answers, KEY, "left").select(
        F.col("file_path").alias("file"),
        "pos",
        "taxonomy_id",
        F.col("q_raw").alias("question_raw"),
        "correct",
        F.when(correct.isNotNull(), by_model).alias("models"),
        F.when(correct.isNull(), F.lit(MISSING_KEY)).alias("error"),
    )


__all__ = [
    "debug_rows",
    "graded",
    "gradable",
    "model_summary",
    "question_report",
    "report_lines",
    "summary_document",
    "with_keys",
]
