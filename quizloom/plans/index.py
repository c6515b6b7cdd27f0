"""Corpus to searchable index table."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.functions.text import has_min_words
from quizloom.operators.ranges import KeyRanges, cut_ranges, place_in_partition
from quizloom.operators.storage import is_complete, materialise, scratch
from quizloom.sources.corpus import ROWS_PER_FILE, read_index, write_index

MIN_WORDS = 20


def usable_documents(corpus: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents with enough words; missing and empty text has none."""
    return corpus.filter(has_min_words(F.col("text"), min_words))


def chunk_ids(corpus: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, chunk_id`` of the usable documents, ids dense in the order of doc_id.

    One scan reads the texts and stores the ids of those with enough words; everything
    after that works on ids.
    """
    ids = _usable_ids(corpus, min_words)
    return _numbered(ids, cut_ranges(ids, ["doc_id"], ROWS_PER_FILE)).select("doc_id", "chunk_id")


def _usable_ids(corpus: DataFrame, min_words: int) -> DataFrame:
    return materialise(usable_documents(corpus.select("doc_id", "text"), min_words).select("doc_id"))


def _numbered(rows: DataFrame, ranges: KeyRanges, *ties: str) -> DataFrame:
    """Add ``chunk_id``: rows of all lower ranges and the row's place in its own.

    Each range becomes one partition, so its rows leave in the order of their ids.
    """
    ordered = ranges.gather(rows, "_range", *ties)
    number = ranges.start(F.col("_range")) + place_in_partition()
    return ordered.withColumn("chunk_id", number).drop("_range")


def chunk_corpus(corpus: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``chunk_id, doc_id, text`` of the usable documents, in the order of their ids.

    No text is joined with its number. Bounds of id ranges and the rows in each are found
    on ids alone; texts then move once, to their range, where their place is their number.
    """
    return embed_corpus(corpus, None, min_words)


def embed_corpus(corpus: DataFrame, embed: Callable | None, min_words: int = MIN_WORDS) -> DataFrame:
    """The chunks with the ``embedding`` of each text, in the order of their ids.

    Texts are embedded in the tasks that read them, before they move, each once.
    """
    corpus = corpus.select("doc_id", "text")
    ranges = cut_ranges(_usable_ids(corpus, min_words), ["doc_id"], ROWS_PER_FILE)
    rows = usable_documents(corpus, min_words)
    if embed is not None:
        rows = rows.withColumn("embedding", embed(F.col("text")))
    numbered = _numbered(rows, ranges, "text")
    return numbered.select("chunk_id", "doc_id", "text", *rows.columns[2:])


def build_index(
    corpus: DataFrame, path: str, embed: Callable, min_words: int = MIN_WORDS
) -> DataFrame:
    """Build the index unless a complete one exists, and return it.

    An existing index is kept even if the corpus has changed; a folder left by a job
    that did not finish is built again.
    """
    spark = corpus.sparkSession
    if not is_complete(spark, path):
        with scratch(spark):
            write_index(embed_corpus(corpus, embed, min_words), path, in_order=True)
    return read_index(spark, path)
