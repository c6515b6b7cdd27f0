"""Importance resampling: a sample of documents whose words look like a target's.

A Regex Split of the tokenizers library, which is never trained, cuts the lower-cased
text into words with their offsets. Windows over neighbouring offset pairs are the
features; a feature's CRC names its bucket. Histograms of all documents and of the target
give each bucket a gain, the logarithm of how much likelier the target is to use it. A
document's weight is the sum of its gains; adding Gumbel noise to the weights and taking
the highest scores draws without replacement in proportion to them.

Texts are split once: each document's buckets are stored, two bytes each, and both the
histograms and the sums read those. Histograms are summed in each task before they move;
a histogram has as many rows as there are buckets, whatever the data. Ranks come from a
range sort of narrow rows, whose ties are parted by a row number, and from the places of
the sorted rows in their files, so no task sees all of them.

Defined results: NULL text is the empty text: no features, weight 0. A NULL ``doc_id``
counts as the empty string in the hash. Rows that repeat are documents of their own;
equal scores rank by the smaller doc_id, NULL last. An empty target has no features, an
empty table no rows. Only ``doc_id`` and ``text`` are read; other columns are ignored.
"""

import functools
import math
import re
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.tasks import releasing
from quizloom.operators.numbering import row_positions
from quizloom.operators.storage import materialise

BUCKETS = 10_000
ORDER = 1
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
# Fixed value: words are runs of digits, lower-case letters and all beyond ASCII.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Texts are split in blocks of about so many characters, cut between words.
BLOCK_CHARS = 1 << 12
_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
_CACHE_WORDS = 1 << 17
_CACHE_CHARS = 48


class _WordCrcs(dict):
    """CRC of a word's bytes; short words are remembered."""

    def __missing__(self, word: str) -> int:
        crc = zlib.crc32(word.encode())
        if len(word) <= _CACHE_CHARS:
            self[word] = crc
        return crc


class Features:
    """CRCs of all runs of 1 to ``order`` words of a text, one by one, with repeats."""

    def __init__(self, order: int = ORDER):
        from tokenizers import Regex
        from tokenizers.pre_tokenizers import Split

        self.order = order
        self._split = Split(Regex(WORD_PATTERN), behavior="removed", invert=True)
        self._crcs = _WordCrcs()

    def words(self, text: str) -> Iterator[list[tuple[str, tuple[int, int]]]]:
        """Words with their offsets in the lower-cased text, block by block."""
        text = text.encode().lower().decode()
        at = 0
        while at < len(text):
            cut = _BETWEEN.search(text, at + BLOCK_CHARS)
            end = cut.end() if cut else len(text)
            found = self._split.pre_tokenize_str(text[at:end])
            yield found if at == 0 else [(w, (s + at, e + at)) for w, (s, e) in found]
            at = end

    def crcs(self, text: str) -> tuple[np.ndarray, int]:
        """The features' CRCs, and the number of words."""
        if len(self._crcs) > _CACHE_WORDS:
            self._crcs.clear()
        parts, n_words = [], 0
        tail: list[str] = []
        for block in self.words(text):
            words = [word for word, _ in block]
            n_words += len(words)
            chain = list(map(self._crcs.__getitem__, words))
            parts.append(np.array(chain, dtype=np.uint32))
            if self.order > 1:
                parts += self._windows(tail, words, chain)
                tail = (tail + words)[-(self.order - 1) :]
        return (np.concatenate(parts) if parts else np.empty(0, np.uint32)), n_words

    def _windows(self, tail: list[str], words: list[str], chain: list[int]):
        """CRCs of the longer runs that end in this block; ``tail`` ends the block before.

        A window of n offset pairs continues the window of its first n-1 words: the CRC goes
        on over a space and the next word.
        """
        row = tail + words
        crcs = [*map(self._crcs.__getitem__, tail), *chain]
        for n in range(2, self.order + 1):
            longer = (w.encode() for w in row[n - 1 :])
            crcs = [zlib.crc32(b" " + w, c) for w, c in zip(longer, crcs)]
            # Window i ends at word i + n - 1; those that end in the tail were counted there.
            yield np.array(crcs[max(0, len(tail) - n + 1) :], dtype=np.uint32)


@functools.lru_cache(maxsize=2)
def _features(order: int) -> Features:
    return Features(order)


def bucket_table(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, buckets`` of every row, stored; ``buckets`` are packed numbers."""
    kind = _kind(buckets)

    def split(batches):
        features = _features(order)
        for batch in batches:
            counts, packed = [], []
            for text in batch.column(1):
                crcs, n_words = features.crcs(text.as_py() or "")
                counts.append(n_words)
                packed.append((crcs % np.uint32(buckets)).astype(kind).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                names=["doc_id", "n_words", "buckets"],
            )

    rows = texts.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words BIGINT, buckets BINARY"
    return materialise(rows.mapInArrow(releasing(split), schema))


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def histogram(table: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows; each task sends one row per bucket at most."""
    kind = _kind(buckets)

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_py(), kind), minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    counted = table.select("buckets").mapInArrow(count, "bucket BIGINT, n BIGINT")
    total = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[bucket] = n
    return total


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain in thousandths: log of its smoothed share in the target over that
    in the source."""
    buckets = float(len(source))
    all_s, all_t = float(source.sum()), float(target.sum())

    def gain(s, t):
        odds = (float(t) + 1) * (all_s + buckets) / ((float(s) + 1) * (all_t + buckets))
        return math.floor(1000 * math.log(odds))

    return np.array([gain(s, t) for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def gumbel(doc_id: str, seed: int) -> int:
    """Noise in thousandths, fixed by seed and doc_id."""
    h = int(sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(table: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of a bucket table's rows."""
    kind = _kind(len(gains))

    def score(batches):
        for batch in batches:
            features, weights, scores = [], [], []
            for doc_id, packed in zip(batch.column(3).to_pylist(), batch.column(2)):
                found = np.frombuffer(packed.as_py(), kind)
                features.append(len(found))
                weights.append(int(gains[found].sum()))
                scores.append(weights[-1] + gumbel(doc_id or "", seed))
            numbers = [pa.array(v, pa.int64()) for v in (features, weights, scores)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *numbers],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    id_type = table.schema["doc_id"].dataType.simpleString()
    rows = table.select("doc_id", "n_words", "buckets", F.col("doc_id").cast("string").alias("id"))
    return rows.mapInArrow(
        score,
        f"doc_id {id_type}, n_words BIGINT, n_features BIGINT, weight BIGINT, score BIGINT",
    )


def rank_drawn(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with the ``rank`` of drawn rows; ``scored`` must be a stored table."""
    usable = F.col("n_words") >= min_words
    draws = scored.filter(usable).count() * percent // 100
    # The number parts rows that are equal in all else, so that no range has to hold them all.
    numbered = scored.withColumn("row", F.monotonically_increasing_id())
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranged = numbered.filter(usable).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = row_positions(materialise(ranged.drop("row")), "rank")
    rank = F.when(F.col("rank") < draws, F.col("rank") + 1)
    rest = scored.filter(~usable).withColumn("rank", F.lit(None).cast("bigint"))
    return placed.withColumn("rank", rank).unionByName(rest)


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    order: int = ORDER,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document.

    ``target`` has a ``text``. ``percent`` of the documents with ``min_words`` words are
    drawn and ranked from 1; all others have no rank.
    """
    own = bucket_table(documents, order, buckets)
    wanted = bucket_table(target.select(F.lit(None).cast("bigint").alias("doc_id"), "text"), order, buckets)
    gains = bucket_gains(histogram(own, buckets), histogram(wanted, buckets))
    return rank_drawn(materialise(score_documents(own, gains, seed)), percent, min_words)


def drawn_documents(documents: DataFrame, ranked: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose ``doc_id`` was drawn, whole."""
    drawn = ranked.filter(F.col("rank").isNotNull()).select("doc_id").distinct()
    return documents.join(drawn, "doc_id", "left_semi")
