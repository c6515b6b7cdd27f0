"""A training corpus from raw documents: filter, deduplicate, mix and pack.

Each stage takes the documents its predecessor kept and returns documents of the same
columns; the last returns the packed pieces. Between stages documents are stored as
tables in the shared folder, so a lost executor costs one stage's work at most.

Stages read ``doc_id, text, lang, source``; any other column passes through untouched,
whatever its name, but for ``n_chars``, which follows the text. NULL text is the empty text,
which the quality rules reject, as they do very short texts. Rows without a doc_id count as
the last document. Repeated rows are judged alike; one of them is left by the n-gram join.
Ties go to the smaller doc_id. Empty tables give empty tables.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.llm import line_dedup, mixing, ngram_join, packing, quality
from quizloom.llm.text import hide
from quizloom.operators.storage import materialise, materialise_alone  # noqa: F401 - one for callers of single stages

# Columns that the stages read; all others are carried along.
READ = ("doc_id", "text", "lang", "source")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; trained on the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.train_quality(docs, labels)
    hidden, show = hide(docs, *READ)
    return show(quality.judge_quality(hidden, model).filter("kept"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has."""
    hidden, show = hide(docs, *READ)
    kept = show(line_dedup.line_dedup(hidden))
    return kept.withColumn("n_chars", F.length("text").cast("bigint"))


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ngram_join.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights; one read in two epochs is there twice."""
    hidden, show = hide(docs, *READ)
    return show(mixing.mix(hidden))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' pieces with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_near),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# The quality model, the banded join and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage. What a stage stores for itself goes when its documents are
    written; in a block of ``scratch`` around the use of the rows the documents go too."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise_alone(spark, lambda: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
