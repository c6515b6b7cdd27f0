"""The whole run: index, leaves, bundles, questions."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.operators.storage import materialise, path_exists, scratch
from quizloom.plans.generate import OPTIONS, QUESTIONS, generate_questions, status_counts
from quizloom.plans.index import build_index
from quizloom.plans.retrieval import BUNDLE_K, build_bundles
from quizloom.plans.seeding import get_prompt, read_leaves
from quizloom.sources.questions import read_bundles, read_question_sets, write_json


def build_benchmark(
    spark: SparkSession,
    corpus: DataFrame,
    folder: str,
    leaf_store: str,
    prompt_store: str,
    prompt_id: str,
    embed: Callable,
    generator: Callable,
    n: int = QUESTIONS,
    k: int = BUNDLE_K,
    options: int = OPTIONS,
    batches: int = 1,
) -> dict[str, int]:
    """Build index, bundles and question sets under ``folder``.

    The index is built once and bundles are rewritten each run. Bundles that already
    have a question set are skipped. Question sets are saved after each of ``batches``
    even parts of the bundles, so a run that breaks off repeats one part at most.
    Returns success, skipped and failed counts. Intermediate tables are removed at the end.
    """
    with scratch(spark):
        leaves = read_leaves(spark, leaf_store)
        if leaves.isEmpty():
            raise ValueError("no taxonomy leaves in the store; seed it first")
        template = get_prompt(spark, prompt_store, prompt_id)
        index = build_index(corpus, f"{folder}/index", embed)
        write_json(build_bundles(leaves, index, embed, k), f"{folder}/bundles")
        bundles = read_bundles(spark, f"{folder}/bundles")
        done = materialise(stored_sets(spark, f"{folder}/questions").select("taxonomy_id"))
        counts = dict.fromkeys(("success", "skipped", "failed"), 0)
        for batch in range(batches):
            part = F.pmod(F.xxhash64("taxonomy_id"), F.lit(batches)) == batch
            sets, status = generate_questions(
                bundles.filter(part),
                template,
                generator,
                done.filter(part),
                prompt_id=prompt_id,
                n=n,
                options=options,
            )
            write_json(sets, f"{folder}/questions", mode="append")
            for name, rows in status_counts(status).first().asDict().items():
                counts[name] += rows
        return counts


def stored_sets(spark: SparkSession, path: str) -> DataFrame:
    """Question sets written so far; an empty table before the first run."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.QUESTION_SET)
    return read_question_sets(spark, path).select("taxonomy_id", "mcqs")
