"""Passages for queries, and bundles of passages for taxonomy leaves."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.functions.taxonomy import query_terms
from quizloom.operators.bundles import collect_passages, with_text
from quizloom.operators.similarity import top_k
from quizloom.operators.storage import materialise

QUERY_K = 3
BUNDLE_K = 4


def retrieve(
    queries: DataFrame,
    index: DataFrame,
    embed: Callable,
    k: int = QUERY_K,
) -> DataFrame:
    """The k best chunks per query: ``query_id, rank, chunk_id, doc_id, text, score``.

    ``queries`` has a unique ``query_id`` and a ``text``. The query vectors are stored
    first, so each text is embedded once. Scoring reads only ids and vectors; texts
    are fetched for the winners.
    """
    vectors = materialise(queries.select("query_id", embed(F.col("text")).alias("embedding")))
    found = with_text(top_k(index, vectors, k), index)
    return found.select("query_id", "rank", "chunk_id", "doc_id", "text", "score")


def passages_for(
    queries: DataFrame, index: DataFrame, embed: Callable, k: int
) -> DataFrame:
    """``query_id, passages`` of each query that has any."""
    return collect_passages(retrieve(queries, index, embed, k), "query_id")


def build_bundles(
    leaves: DataFrame,
    index: DataFrame,
    embed: Callable,
    k: int = BUNDLE_K,
) -> DataFrame:
    """One bundle per leaf: id, query terms and its k best passages.

    Synonyms are recorded among the query terms, but only the label is searched for.
    The leaf's difficulty is not carried over.
    """
    queries = leaves.select(F.col("id").alias("query_id"), F.col("label").alias("text"))
    passages = passages_for(queries, index, embed, k)
    synonyms = F.col("synonyms") if "synonyms" in leaves.columns else None
    named = leaves.select("id", query_terms(F.col("label"), synonyms).alias("query_terms"))
    none = F.array().cast(schemas.BUNDLE["passages"].dataType)
    return named.join(passages, named["id"] == passages["query_id"], "left").select(
        F.col("id").alias("taxonomy_id"),
        "query_terms",
        F.coalesce("passages", none).alias("passages"),
    )
