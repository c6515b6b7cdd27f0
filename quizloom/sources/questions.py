"""Bundles, question sets and reports as JSON, and the review sheet as CSV."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.operators.columns import free_name, with_computed
from quizloom.operators.ranges import cut_ranges
from quizloom.operators.storage import materialise
from quizloom.sources.json_text import parse, read_texts

ROWS_PER_FILE = 1 << 15


def _documents(spark, path, schema, file_per_row, skip_bad) -> DataFrame:
    """``path, name, doc`` of JSON documents; unreadable ones raise or are left out."""
    texts = read_texts(spark, path, "*.json", file_per_row)
    doc = parse(F.col("text"), schema)
    if not skip_bad:
        doc = F.coalesce(doc, F.raise_error(F.concat(F.lit("unreadable JSON in "), F.col("path"))))
    rows = with_computed(texts, "doc", doc)
    return rows.filter(F.col("doc").isNotNull()).select("path", "name", "place", "doc")


def _stem(name: str):
    return F.regexp_replace(name, r"\.json$", "")


def read_bundles(spark: SparkSession, path: str, file_per_row: bool = False) -> DataFrame:
    """Bundles, one per line as this engine writes them, or one per file."""
    rows = _documents(spark, path, schemas.BUNDLE, file_per_row, skip_bad=False)
    return rows.select("doc.*")


def read_question_sets(
    spark: SparkSession, path: str, file_per_row: bool = False, skip_bad: bool = False
) -> DataFrame:
    """``file_path, taxonomy_id, mcqs`` of stored question sets.

    A set without ``mcqs`` has none; one without an id, in a file of its own, takes
    the file's stem. Sets that share a file get the path their own file would have;
    those without an id get their file's path and their number in the scan of it.
    Unreadable sets raise, or are left out with ``skip_bad``.
    """
    rows = _documents(spark, path, schemas.QUESTION_SET, file_per_row, skip_bad)
    if file_per_row:
        file_path = F.col("path")
        taxonomy_id = F.coalesce("doc.taxonomy_id", _stem("name"))
    else:
        taxonomy_id = F.col("doc.taxonomy_id")
        folder = F.lit(path.rstrip("/") + "/")
        # A set without an id is known by its file and its place there.
        place = F.concat("path", F.lit("#"), F.col("place").cast("string"))
        file_path = F.coalesce(F.concat(folder, taxonomy_id, F.lit(".json")), place)
    return rows.select(
        file_path.alias("file_path"),
        taxonomy_id.alias("taxonomy_id"),
        F.coalesce("doc.mcqs", F.array().cast("array<string>")).alias("mcqs"),
    )


def explode_questions(sets: DataFrame) -> DataFrame:
    """One row per question text; ``(file_path, pos)`` is its key, duplicates stay."""
    return sets.select("file_path", "taxonomy_id", F.posexplode("mcqs").alias("pos", "q_raw"))


def first_questions(questions: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` questions by file and position; all of them for None."""
    return questions if n is None else questions.orderBy("file_path", "pos").limit(n)


def write_json(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.write.mode(mode).json(path)


def write_ordered(rows: DataFrame, path: str, *order: str) -> None:
    """JSON lines whose files, by name, follow the order.

    The keys are counted first, without the other columns, and cut into ranges of
    ``ROWS_PER_FILE`` rows; each row then goes to its file and is computed once, models'
    grades included. A sort would compute all rows twice, as it samples them.
    """
    keys = materialise(rows.select(*order))
    ranges = cut_ranges(keys, list(order), ROWS_PER_FILE)
    name = free_name(rows.columns, "range")
    write_json(ranges.gather(rows, name).drop(name), path)


def write_document(document: DataFrame, path: str) -> None:
    """A one-row document as a single text file."""
    document.coalesce(1).write.mode("overwrite").text(path)


def write_sheet(lines: DataFrame, path: str) -> None:
    """Ordered CSV lines as text; lines end with CR LF, and cells keep their line feeds."""
    lines.write.mode("overwrite").option("lineSep", "\r\n").text(path)
