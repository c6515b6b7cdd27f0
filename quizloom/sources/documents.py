"""Directories of small JSON and YAML documents: taxonomies and prompt templates.

Load order decides which document wins a key: format first, then path, then the
position inside the file. The order is part of the rows, not of the scan.
"""

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.functions.batches import by_bytes
from quizloom.operators.columns import with_computed
from quizloom.operators.storage import empty_files
from quizloom.sources.json_text import parse, read_small_files, read_texts


# Tasks that read the files of a folder, per core and format.
TASKS_PER_CORE = 8
NOT_A_DOCUMENT = "not a document of the expected form"
# Characters with which libyaml, some ten times as fast, accepts no text that PyYAML's own
# parser reads otherwise or rejects: no tags, anchors, block scalars, directives, question
# marks, tabs, nor other line breaks than newlines.
_PLAIN = re.compile(
    r"[\n \"-$'()+-=@-{}~\xa0-\u2027\u202a-\ud7ff\ue000-\ufefe\uff00-\ufffd\U00010000-\U0010ffff]*"
)
# Texts that may be nested deeper are left to the latter, which has a limit.
_FLAT = 50
_DEEP_LINE = re.compile(rf"^[ :-]{{{_FLAT}}}", re.MULTILINE)


def _is_simple(text: str) -> bool:
    """True if both YAML parsers read the text alike, should the quick one accept it."""
    if text.count("[") + text.count("{") > _FLAT or not _PLAIN.fullmatch(text):
        return False
    return _DEEP_LINE.search(text) is None


@F.arrow_udf(schemas.CONVERTED)
def _yaml_to_json(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A YAML text as JSON, or where and why it is not YAML."""
    import yaml

    quick = getattr(yaml, "CSafeLoader", None)

    def load(text):
        if quick is not None and _is_simple(text):
            try:
                return yaml.load(text, quick)
            except (yaml.YAMLError, ValueError):
                pass  # The reason, and its words, come from the other parser.
        return yaml.safe_load(text)

    def convert(text):
        try:
            return json.dumps(load(text or ""), ensure_ascii=False, default=str), None, None
        except yaml.MarkedYAMLError as error:
            mark = error.problem_mark
            return None, mark and f"{mark.line + 1}:{mark.column + 1}", error.problem
        except (yaml.YAMLError, ValueError, RecursionError) as error:
            return None, None, f"{type(error).__name__}: {error}".splitlines()[0]

    yield from _converted(batches, convert, ["text", "place", "reason"])


@F.arrow_udf(schemas.PROBLEM)
def _json_problem(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Where and why a text is not JSON; NULLs for one that is, and for NULL."""

    def convert(text):
        if text is None:
            return None, None
        try:
            json.loads(text)
            return None, None
        except json.JSONDecodeError as error:
            return f"{error.lineno}:{error.colno}", error.msg
        except RecursionError:
            return None, "nested too deeply"

    yield from _converted(batches, convert, ["place", "reason"])


def _converted(batches, convert, names) -> Iterator[pa.Array]:
    for batch in batches:
        rows = [convert(text) for (texts,) in by_bytes((batch,)) for text in texts]
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)


def _read(spark, path, as_doc, check, yaml_rank: int, json_rank: int) -> DataFrame:
    """One row per file: ``path, format_rank, doc, problem``.

    ``problem`` says where and why a file is not a document, or what ``check``, a column
    function of the document, has against it. It is NULL for all others, whose ``doc`` is
    not NULL. Only files that do not parse are looked at for a reason.
    """
    empty = empty_files(spark, path)
    listed = read_small_files(spark, path, "*.{json,yaml}")
    yaml_texts = _folder_files(listed, ".yaml", yaml_rank, empty)
    yaml_files = with_computed(yaml_texts, "json", _yaml_to_json("text"))
    json_files = _folder_files(listed, ".json", json_rank, empty)
    as_yaml = yaml_files.withColumn("text", F.col("json.text")).withColumn(
        "found", F.when(F.col("json.text").isNull(), F.struct("json.place", "json.reason"))
    ).drop("json")
    files = as_yaml.unionByName(json_files.withColumn("found", F.lit(None).cast(schemas.PROBLEM)))
    read = with_computed(files, "doc", as_doc(F.col("text")))
    unread = F.col("doc").isNull()
    why = _json_problem(F.when(unread & F.col("found").isNull(), F.col("text")))
    named = with_computed(read, "why", why)
    reason = F.coalesce("found.reason", "why.reason", F.lit(NOT_A_DOCUMENT))
    place = F.coalesce("found.place", "why.place")
    against = check(F.col("doc"))
    problem = F.when(unread, F.struct(place.alias("place"), reason.alias("reason"))).when(
        against.isNotNull(), F.struct(F.lit(None).cast("string").alias("place"), against.alias("reason"))
    )
    return named.select("path", "format_rank", "doc", problem.alias("problem"))


def accepted(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col("problem").isNull()).drop("problem")


def rejected(documents: DataFrame) -> DataFrame:
    """``path, place, reason`` of the files that are left out; ``place`` is line and column."""
    return documents.filter(F.col("problem").isNotNull()).select("path", "problem.*")


def _ranked(files, rank) -> DataFrame:
    return files.select("text", "path", F.lit(rank).alias("format_rank"))


def _folder_files(listed, suffix, rank, empty) -> DataFrame:
    """Files of a format; Spark's readers pass over the ``empty`` ones, which are added here.

    The folder has been listed once for all formats; names are looked at before files are.
    Spark reads few files in a task, as it takes the opening of one for megabytes. A task here
    goes on to the next files with the same Python process, and writes one file of rows.
    """
    spark = listed.sparkSession
    files = _ranked(listed.filter(F.col("name").endswith(suffix)), rank)
    files = files.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    names = [name for name in empty if name.endswith(suffix)]
    rows = spark.createDataFrame([("", name, rank) for name in names], files.schema)
    return files.unionByName(rows) if names else files


def _taxonomy(text: Column) -> Column:
    return parse(text, schemas.TAXONOMY)


def _taxonomy_lacks(doc: Column) -> Column:
    return F.when(doc["domain"].isNull(), "no domain").when(doc["categories"].isNull(), "no categories")


def read_taxonomies(spark: SparkSession, path: str) -> DataFrame:
    """All ``*.yaml``, then all ``*.json`` taxonomies of a folder; ``path, format_rank, doc, problem``."""
    return _read(spark, path, _taxonomy, _taxonomy_lacks, yaml_rank=0, json_rank=1)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """A single YAML taxonomy file."""
    files = _ranked(read_texts(spark, path, "*", file_per_row=True), 0)
    doc = parse(_yaml_to_json("text")["text"], schemas.TAXONOMY)
    return files.select("path", "format_rank", doc.alias("doc"))


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """All ``*.json``, then all ``*.yaml`` templates of a folder, with all their fields;
    ``path, format_rank, doc, problem``."""
    return _read(spark, path, _prompt, _prompt_lacks, yaml_rank=1, json_rank=0)


def _prompt_lacks(doc: Column) -> Column:
    return F.when(doc["prompt_id"].isNull(), "no prompt_id")


def _prompt(text: Column) -> Column:
    """A template's known fields as texts, whatever their type, and all others."""
    fields = F.from_json(text, "MAP<STRING, STRING>")
    known = [c for c in schemas.PROMPT.names if c != "extra"]
    others = F.map_filter(fields, lambda name, _: ~name.isin(known))
    doc = F.struct(
        *[F.element_at(fields, c).alias(c) for c in known],
        F.when(F.size(others) > 0, others).alias("extra"),
    )
    return F.when(fields.isNotNull(), doc)


def one_row_or_error(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Rows with the key; raises if there is none."""
    found = rows.filter(F.col(key) == value)
    if found.isEmpty():
        raise ValueError(f"no {key} {value!r} in the store")
    return found
