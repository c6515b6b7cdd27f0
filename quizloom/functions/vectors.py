"""Embeddings and inner products."""

import functools
import hashlib
from collections.abc import Callable, Sequence
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quizloom.functions.batches import BATCH_BYTES, by_bytes
from quizloom.schemas import EMBEDDING

DEFAULT_DIM = 64
# Words whose buckets a task of the hash embedder remembers.
CACHED_WORDS = 1 << 16


def inner_product(left: Column, right: Column) -> Column:
    """Sum of element products, added in element order in double precision."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def embedder(
    make_client: Callable[[], Callable[[list], Sequence]],
    batch_size: int | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> Callable:
    """Column function text -> vector backed by an embedding client.

    ``make_client`` runs once per task and returns a function from a list of texts
    to one equally long vector per text. NULL texts get a NULL vector and are never
    sent to the client. Calls are marked nondeterministic, or a filter on the vectors
    would make Catalyst embed every text twice. A call gets at most ``batch_size`` texts, if
    given, and ``batch_bytes`` of text in all, but one text at least.
    """

    @F.arrow_udf(EMBEDDING)
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        client = make_client()
        for batch in batches:
            present = np.asarray(batch.is_valid())
            texts_only = batch.drop_null() if batch.null_count else batch
            slices = by_bytes((texts_only,), batch_bytes, batch_size)
            parts = [np.asarray(client(texts), dtype=np.float32) for (texts,) in slices]
            yield _list_array(present, np.concatenate(parts) if parts else None)

    return embed.asNondeterministic()


def _list_array(present: np.ndarray, vectors: np.ndarray | None) -> pa.Array:
    width = 0 if vectors is None else vectors.shape[1]
    lengths = np.where(present, width, 0)
    offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), type=pa.int32())
    flat = np.empty(0, np.float32) if vectors is None else vectors.reshape(-1)
    return pa.ListArray.from_arrays(
        offsets, pa.array(flat), mask=pa.array(~present)
    )


def hash_embedder(dim: int = DEFAULT_DIM) -> Callable:
    """Embedder that needs no model: word counts over hashed buckets, unit length.

    A word's bucket is the number in the first eight hex digits of its MD5, modulo
    ``dim``. A text without words gets the zero vector.
    """

    def make_client():
        @functools.lru_cache(maxsize=CACHED_WORDS)
        def bucket(word):
            return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim

        def embed(texts):
            counts = np.zeros((len(texts), dim))
            for row, text in zip(counts, texts):
                words = text.lower().split()
                hits = np.fromiter(map(bucket, words), np.int64, len(words))
                row += np.bincount(hits, minlength=dim)
            norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            return counts / np.where(norms == 0, 1, norms)

        return embed

    return embedder(make_client)
