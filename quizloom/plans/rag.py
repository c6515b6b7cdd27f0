"""Retrieval-augmented answers to the questions, graded for support and relevance."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.functions.mcq import question_stem
from quizloom.functions.models import faithfulness_by_overlap, relevancy_by_overlap
from quizloom.operators.asking import ask
from quizloom.operators.bundles import context
from quizloom.operators.columns import with_computed
from quizloom.operators.storage import materialise
from quizloom.plans.retrieval import BUNDLE_K, passages_for
from quizloom.sources.questions import first_questions, write_ordered


def question_stems(questions: DataFrame, limit: int | None = None) -> DataFrame:
    """Stems of all questions, or of the first ``limit``; then those without one drop out."""
    chosen = first_questions(questions, limit)
    stems = with_computed(chosen, "query", question_stem(F.col("q_raw")))
    return stems.filter(F.col("query") != "").select("file_path", "pos", "query")


def evaluate_rag(
    questions: DataFrame,
    index: DataFrame,
    embed: Callable,
    answerer: Callable,
    faithful: Callable | None = None,
    relevant: Callable | None = None,
    limit: int | None = None,
    k: int = BUNDLE_K,
) -> DataFrame:
    """Answer each question from its k best passages and grade the answer.

    ``answerer`` is a column function (question, context) -> ``STRUCT<raw, error>``;
    graders are column functions (question, answer, context) -> ``STRUCT<passing, score,
    error>`` and compare words by default. Passages are found by ``chunk_id``.

    A question whose answer failed has no response and no grades, and says why in
    ``error``; so does one whose grading failed.
    """
    by_models = faithful is not None or relevant is not None
    faithful = faithful or faithfulness_by_overlap()
    relevant = relevant or relevancy_by_overlap()
    stems = materialise(question_stems(questions, limit))
    queries = stems.select(
        F.struct("file_path", "pos").alias("query_id"), F.col("query").alias("text")
    )
    found = passages_for(queries, index, embed, k)
    read = queries.join(found, "query_id", "left").select(
        "query_id",
        F.col("text").alias("query"),
        F.coalesce(context(F.col("passages")), F.lit("")).alias("context"),
    )
    answered = materialise(ask(read, answerer, [F.col("query"), F.col("context")], "reply"))
    failed = F.col("reply.error").isNotNull()
    answered = answered.withColumn(
        "response", F.when(~failed, F.coalesce("reply.raw", F.lit("")))
    )
    triple = (F.col("query"), F.col("response"), F.col("context"))
    graded = answered.select(
        "query_id.*",
        "query",
        "response",
        "reply.error",
        F.when(~failed, faithful(*triple)).alias("f"),
        F.when(~failed, relevant(*triple)).alias("r"),
    )
    if by_models:
        # Graders are asked once however often the result is used.
        graded = materialise(graded)
    return graded.select(
        "file_path",
        "pos",
        "query",
        "response",
        F.col("f.passing").alias("is_faithful"),
        F.col("f.score").alias("faithfulness_score"),
        F.col("r.passing").alias("is_relevant"),
        F.col("r.score").alias("relevancy_score"),
        F.coalesce("error", "f.error", "r.error").alias("error"),
    )


def write_rag_report(graded: DataFrame, path: str) -> None:
    """The evaluation as JSON lines, by file and position."""
    write_ordered(graded, path, "file_path", "pos")
