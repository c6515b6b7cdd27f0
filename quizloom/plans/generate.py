"""Question generation from context bundles."""

from collections.abc import Callable
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.functions.mcq import extract_blocks, extract_blocks_with, reply_failed
from quizloom.functions.patterns import to_java
from quizloom.functions.prompts import render, template_tokens, unknown_fields
from quizloom.functions.taxonomy import leaf_label
from quizloom.operators.asking import ask
from quizloom.operators.bundles import context
from quizloom.operators.columns import with_computed
from quizloom.operators.joins import lookup_join
from quizloom.operators.storage import materialise, new_folder

QUESTIONS = 3
OPTIONS = 8
DEFAULT_DIFFICULTY = "H"
FIELDS = ["n", "diff_tag", "leaf_label", "context", "options"]
SUCCESS, SKIPPED, FAILED = "Success", "Skipped", "Failed"
PATTERNS_AT_ONCE = 10_000
_RUNNABLE = "_pattern STRING, _runnable STRING, pattern_groups INT, pattern_problem STRING"


def pending_bundles(bundles: DataFrame, done: DataFrame) -> DataFrame:
    """Bundles without a question set yet."""
    return bundles.join(done.select("taxonomy_id"), "taxonomy_id", "left_anti")


def with_template(bundles: DataFrame, prompts: DataFrame) -> DataFrame:
    """Add each bundle's template, cut into tokens; NULL where the id is unknown.

    Patterns come in the dialect that runs them, with their number of groups, or with
    the reason why they cannot run.
    """
    templates = with_runnable_patterns(prompts).select(
        "prompt_id",
        template_tokens(F.col("template")).alias("tokens"),
        "parser_regex",
        "pattern_groups",
        "pattern_problem",
    )
    return lookup_join(bundles, templates, "prompt_id", F.col("taxonomy_id"), how="left")


def _runnable(spark: SparkSession, pattern: str) -> tuple:
    """The pattern in the dialect that runs it and its groups, or why there is none."""
    try:
        runnable, groups = to_java(pattern)
        spark._jvm.java.util.regex.Pattern.compile(f"(?sdU){runnable}")
        return pattern, runnable, groups, None
    except ValueError as error:
        return pattern, None, None, f"unusable pattern: {error}"
    except Py4JJavaError as error:
        return pattern, None, None, f"unusable pattern: {error.java_exception.getDescription()}"


def with_runnable_patterns(prompts: DataFrame) -> DataFrame:
    """Replace ``parser_regex`` by a pattern that Spark can run.

    Adds ``pattern_groups``, and ``pattern_problem`` where there is no such pattern. Each
    distinct pattern is compiled once, by the dialect that will run it, which only the
    driver can ask for a reason; it holds ``PATTERNS_AT_ONCE`` of them at a time.
    """
    spark = prompts.sparkSession
    distinct = prompts.select("parser_regex").filter(F.col("parser_regex").isNotNull()).distinct()
    patterns = (row[0] for row in distinct.toLocalIterator())
    known, path = None, new_folder(spark, "patterns")
    while known is None or len(part) == PATTERNS_AT_ONCE:
        part = list(islice(patterns, PATTERNS_AT_ONCE))
        rows = spark.createDataFrame([_runnable(spark, p) for p in part], _RUNNABLE)
        if known is None and len(part) < PATTERNS_AT_ONCE:
            known = rows
        else:
            rows.write.mode("append").parquet(path)
            known = spark.read.schema(rows.schema).parquet(path)
    joined = prompts.join(known, prompts["parser_regex"] == known["_pattern"], "left")
    columns = [c if c != "parser_regex" else F.col("_runnable").alias(c) for c in prompts.columns]
    return joined.select(*columns, "pattern_groups", "pattern_problem")


def bundle_prompt(tokens: Column, n: int, options: int, difficulty: Column) -> Column:
    """The prompt of a bundle row with ``taxonomy_id`` and ``passages``."""
    return render(
        tokens,
        {
            "n": F.lit(n),
            "diff_tag": F.coalesce(difficulty, F.lit(DEFAULT_DIFFICULTY)),
            "leaf_label": leaf_label(F.col("taxonomy_id")),
            "context": context(F.col("passages")),
            "options": F.lit(options),
        },
    )


def render_prompts(
    bundles: DataFrame, prompts: DataFrame, n: int = QUESTIONS, options: int = OPTIONS
) -> DataFrame:
    """Add ``prompt``, ``parser_regex`` and ``problem`` to bundles with ``prompt_id``.

    ``problem`` says why a bundle has no prompt: an unknown template, one whose pattern
    cannot run, or one with fields no value exists for.
    """
    rows = with_template(bundles, prompts)
    difficulty = F.col("difficulty") if "difficulty" in bundles.columns else F.lit(None)
    unknown = unknown_fields(F.col("tokens"), FIELDS)
    problem = F.when(
        F.col("tokens").isNull(), F.concat(F.lit("unknown prompt "), F.col("prompt_id"))
    ).when(F.col("pattern_problem").isNotNull(), F.col("pattern_problem")).when(
        F.size(unknown) > 0, F.concat(F.lit("unknown fields "), F.array_join(unknown, " "))
    )
    prompt = bundle_prompt(F.col("tokens"), n, options, difficulty.cast("string"))
    return rows.withColumn("problem", problem).withColumn(
        "prompt", F.when(F.col("problem").isNull(), prompt)
    )


def generate_replies(rendered: DataFrame, generator: Callable) -> DataFrame:
    """Ask the generator for every prompt; ``raw`` is set exactly if it succeeded.

    Replies are stored before use, so a bundle is asked for once; only a task that is run
    again, after a loss say, asks again for its own bundles. A generator with a journal
    is asked only for what no earlier task or run got. A reply that
    only reports an error is a failure, not an empty question set.
    """
    narrow = rendered.select("taxonomy_id", "parser_regex", "pattern_groups", "problem", "prompt")
    stored = materialise(ask(narrow, generator, [F.col("prompt")], "reply").drop("prompt"))
    raw = F.col("reply.raw")
    failed = F.col("problem").isNotNull() | F.col("reply.error").isNotNull() | reply_failed(raw)
    error = F.coalesce("problem", "reply.error", raw, F.lit("no reply"))
    return stored.select(
        "taxonomy_id",
        "parser_regex",
        "pattern_groups",
        F.when(~failed, raw).alias("raw"),
        F.when(failed, error).alias("error"),
    )


def parse_replies(replies: DataFrame) -> DataFrame:
    """Question sets of the successful replies, questions in text order.

    The requested number of questions is not enforced. Templates without a pattern
    use the standard one.
    """
    raw, pattern = F.col("raw"), F.col("parser_regex")
    blocks = F.when(pattern.isNull(), extract_blocks(raw)).otherwise(
        extract_blocks_with(raw, pattern, F.col("pattern_groups"))
    )
    succeeded = replies.filter(raw.isNotNull())
    return with_computed(succeeded, "mcqs", blocks).select("taxonomy_id", "mcqs")


def statuses(bundles: DataFrame, done: DataFrame, replies: DataFrame) -> DataFrame:
    """``taxonomy_id, status, error`` of every bundle of a run."""
    skipped = bundles.select("taxonomy_id").join(done.select("taxonomy_id"), "taxonomy_id", "left_semi").select(
        "taxonomy_id",
        F.lit(SKIPPED).alias("status"),
        F.lit(None).cast("string").alias("error"),
    )
    ran = replies.select(
        "taxonomy_id",
        F.when(F.col("error").isNull(), SUCCESS).otherwise(FAILED).alias("status"),
        "error",
    )
    return ran.unionByName(skipped)


def status_lines(rows: DataFrame) -> DataFrame:
    detail = F.when(
        F.col("status") == FAILED, F.concat(F.lit(" with error: "), F.col("error"))
    ).otherwise("")
    line = F.concat("status", F.lit(": "), "taxonomy_id", detail)
    return rows.select("taxonomy_id", line.alias("line"))


def status_counts(rows: DataFrame) -> DataFrame:
    """One row ``success, skipped, failed``."""
    status = F.col("status")
    return rows.agg(
        F.count_if(status == SUCCESS).alias("success"),
        F.count_if(status == SKIPPED).alias("skipped"),
        F.count_if((status != SUCCESS) & (status != SKIPPED)).alias("failed"),
    )


def generate_questions(
    bundles: DataFrame,
    prompts: DataFrame,
    generator: Callable,
    done: DataFrame,
    prompt_id: str | None = None,
    n: int = QUESTIONS,
    options: int = OPTIONS,
) -> tuple[DataFrame, DataFrame]:
    """Question sets for the bundles not in ``done``, and the status of every bundle.

    ``prompt_id`` selects one template for all bundles; without it each bundle names
    its own. ``done`` must be the table the question sets are appended to, so a second
    run skips them. Failed bundles write nothing and are tried again next time.
    """
    if prompt_id is not None:
        bundles = bundles.withColumn("prompt_id", F.lit(prompt_id))
    rendered = render_prompts(pending_bundles(bundles, done), prompts, n, options)
    replies = generate_replies(rendered, generator)
    return parse_replies(replies), statuses(bundles, done, replies)
