"""SpotSigs fingerprints: chains of content words that follow common words.

Running text is full of short common words; headings, tables and boilerplate are not. A
common word is a spot, and its signature is the spot with the next content words after
it. The distinct signatures are the document's fingerprint, so an edit changes only the
signatures of the chains it touches.

Where no common word is among the last ``GAP`` words, or none has come yet, each word is a
spot of its own, so that texts of other languages and lists have signatures too. A text
without words has one signature, of its characters. Equal texts have equal fingerprints,
which depend on the text alone and not on the corpus.

Fingerprints are compared by the Jaccard coefficient of their sets. Sets belong to
partitions by length, so wide that sets of partitions which are not neighbours cannot be
alike enough; those are never compared. The others are compared block by block in
signature order, and left as soon as what remains cannot lift them to ``MIN_LIKENESS``.
A likeness below that is 0; all others are exact.

:func:`fingerprint` is one pass without a shuffle. :func:`compare_neighbours` needs each
text beside the next one's beginning: rows move once, into ranges of doc_id whose cuts are
known beforehand, and the first row of each range is also sent, as far as it is needed, to
the range before it.

Defined results: NULL text is the empty text. Documents follow one another by descending
doc_id, NULL last; rows that share a doc_id by a hash of their text, then by the text. A
single document is its own next one. An empty table has no rows. Only ``doc_id`` and
``text`` are read by :func:`compare_neighbours`; :func:`fingerprint` keeps other columns,
but for one named ``fingerprint``, which is replaced.
"""

import base64
import functools
import json
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.tasks import releasing
from quizloom.llm.text import others
from quizloom.operators.columns import with_computed
from quizloom.operators.joins import fits
from quizloom.operators.storage import materialise

# Common words of English, German, French and Spanish.
ANCHORS = tuple(
    """
    a an and are as at be but by for from had has have he her his i in is it not of on or
    she that the they this to was were which with you
    als auf das dem den der des die ein eine er es für im ist mit nicht sich sie und von zu
    au aux avec ce dans de des du elle en est et il la le les ou par pas pour que qui se sur un une
    al con del el ella en es la las lo los no para por que se son su un una y
    """.split()
)
CHAIN = 3
GAP = 24
MIN_LIKENESS = 0.1
# Distinct documents and bytes of text that a range should hold, and most ranges there are.
RANGE_ROWS = 20_000
RANGE_BYTES = 16 << 20
MAX_RANGES = 20_000
# Rows alike in doc_id and text beyond which they travel as one.
HOT_ROWS = 1_000
# Rows and bytes of results in a batch.
_BATCH_ROWS, _BATCH_BYTES = 1_000, 16 << 20
_WORD = re.compile(r"[^\W_]+")
_BLOCK_CHARS = 1 << 20
_CACHE_WORDS = 1 << 17
_CACHE_CHARS = 48
_COMPARED_AT_ONCE = 1 << 12
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class SpotSignatures:
    """Sorted distinct 32-bit signatures of a text."""

    def __init__(self, anchors=ANCHORS, chain: int = CHAIN, gap: int = GAP):
        self.anchors, self.chain, self.gap = frozenset(anchors), chain, gap
        self._known: dict[str, int] = {}

    def _hash(self, word: str) -> int:
        """Hash of a word whose lowest bit says whether it is an anchor."""
        code = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        code = code | 1 if word in self.anchors else code & ~1
        if len(word) <= _CACHE_CHARS:
            self._known[word] = code
        return code

    def _codes(self, text: str) -> np.ndarray:
        known, parts, at = self._known, [], 0
        if len(known) > _CACHE_WORDS:
            known.clear()
        while at < len(text):
            end = at + _BLOCK_CHARS
            if end < len(text):
                # A block ends after a whole word.
                inside = _WORD.match(text, end)
                end = inside.end() if inside else end
            words = _WORD.findall(text[at:end].lower())
            codes = [known.get(w) or self._hash(w) for w in words]
            parts.append(np.array(codes, dtype=np.uint64))
            at = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def __call__(self, text: str) -> np.ndarray:
        codes = self._codes(text)
        if not len(codes):
            return np.array([xxhash.xxh32_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint32)
        is_anchor = (codes & np.uint64(1)).astype(bool)
        place = np.arange(len(codes))
        anchor_place = np.where(is_anchor, place, -self.gap - 1)
        before = np.concatenate([[-self.gap - 1], np.maximum.accumulate(anchor_place)[:-1]])
        spots = np.flatnonzero(is_anchor | (before < 0) | (place - before > self.gap))
        content = np.append(codes[~is_anchor], np.zeros(self.chain, np.uint64))
        # Content words up to and with each word: where the chain of a spot begins.
        first = np.cumsum(~is_anchor)[spots]
        value = codes[spots] * _MIX
        for step in range(self.chain):
            value = (value ^ (value >> np.uint64(29))) * _STEP + content[first + step]
        value = (value ^ (value >> np.uint64(32))) * _MIX
        return np.unique((value >> np.uint64(32)).astype(np.uint32))


def encode(signatures: np.ndarray) -> str:
    """A fingerprint as text: base64 of the sorted signatures, high byte first."""
    return base64.b64encode(signatures.astype(">u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype=">u4").astype(np.uint32)


def length_partition(length: int, least: float) -> int:
    """Partition of a set's length: its bounds grow by 1 / ``least``.

    Sets of partitions that are not neighbours differ in length by a larger factor, so
    their Jaccard coefficient is below ``least``.
    """
    partition, bound = 0, 1.0 / least
    while length >= bound:
        partition, bound = partition + 1, bound / least
    return partition


def jaccard(a: np.ndarray, b: np.ndarray, least: float = MIN_LIKENESS) -> float:
    """Jaccard coefficient of two sorted sets; 0 if it is below ``least``."""
    if len(a) > len(b):
        a, b = b, a
    if length_partition(len(b), least) - length_partition(len(a), least) > 1:
        return 0.0
    total, common = len(a) + len(b), 0
    for at in range(0, len(a), _COMPARED_AT_ONCE):
        # The most that the signatures not yet looked up can add.
        most = common + len(a) - at
        if most < least * (total - most):
            return 0.0
        part = a[at : at + _COMPARED_AT_ONCE]
        place = np.searchsorted(b, part)
        place[place == len(b)] = 0
        common += int(np.count_nonzero(b[place] == part))
    likeness = common / (total - common)
    return likeness if likeness >= least else 0.0


@functools.lru_cache(maxsize=2)
def _signer(anchors: tuple[str, ...], chain: int, gap: int) -> SpotSignatures:
    return SpotSignatures(anchors, chain, gap)


def fingerprint(
    documents: DataFrame, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN, gap: int = GAP
) -> DataFrame:
    """``documents`` with the ``fingerprint`` of each text."""

    @F.arrow_udf("string")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        signer = _signer(anchors, chain, gap)
        for texts in batches:
            yield pa.array([encode(signer(t.as_py() or "")) for t in texts], pa.string())

    return documents.select(*others(documents, "fingerprint"), sign("text").alias("fingerprint"))


_KEY = "STRUCT<none: BOOLEAN, down: BIGINT, hash: BIGINT>"


def _key() -> Column:
    """Orders documents as they follow one another: by descending doc_id, NULL last."""
    return F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.coalesce(F.bitwise_not("doc_id"), F.lit(0).cast("bigint")).alias("down"),
        F.xxhash64("text").alias("hash"),
    )


def _distinct_keys(rows: DataFrame) -> DataFrame:
    """Keys with their rows and bytes of text, stored."""
    bytes_ = F.octet_length("text").cast("bigint")
    narrow = rows.select(F.col("key"), bytes_.alias("bytes"))
    return materialise(
        narrow.groupBy("key").agg(F.count("*").alias("copies"), F.sum("bytes").alias("bytes"))
    )


def _first_keys(keys: DataFrame) -> list[tuple]:
    """The first key of every range; one row per range comes to the driver."""
    size = keys.agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).first()
    ranges = max(size["rows"] // RANGE_ROWS, (size["bytes"] or 0) // RANGE_BYTES) + 1
    ranged = keys.select("key").repartitionByRange(min(ranges, MAX_RANGES), "key")
    firsts = ranged.groupBy(F.spark_partition_id()).agg(F.min("key").alias("first"))
    return sorted(tuple(row["first"]) for row in firsts.collect())


def _collapse_hot(rows: DataFrame, keys: DataFrame, hot_rows: int) -> DataFrame:
    """``rows`` with ``copies``: rows that repeat both doc_id and text very often as one.

    All other rows stay as they are, and nothing of them moves.
    """
    hot = keys.filter(F.col("copies") > hot_rows).select("key")
    single = rows.withColumn("copies", F.lit(1).cast("bigint"))
    if hot.isEmpty():
        return single
    if fits(hot):
        hot = F.broadcast(hot)
    repeated = rows.join(hot, "key", "left_semi").groupBy("key", "doc_id", "text")
    once = repeated.agg(F.count("*").alias("copies"))
    return single.join(hot, "key", "left_anti").unionByName(once)


def _range_of(key: Column, firsts: Column, count: int) -> Column:
    """The last of the sorted ``firsts`` that is not above the key, by halving."""
    steps = F.lit([1 << bit for bit in reversed(range(count.bit_length()))])

    def halve(low, step):
        return F.when(F.get(firsts, low + step) <= key, low + step).otherwise(low)

    return F.aggregate(steps, F.lit(0), halve)


def _ordered(rows: DataFrame, hot_rows: int) -> DataFrame:
    """``range, ahead, doc_id, text, copies``, each range in one task and in order.

    A range ends with the first row of the next one, marked as ``ahead``; the last range
    with the first row of all.
    """
    rows = rows.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(_key().alias("key"), "*")
    keys = _distinct_keys(rows)
    cuts = _first_keys(keys)
    count = max(len(cuts), 1)
    firsts = F.from_json(
        F.lit(json.dumps([dict(zip(("none", "down", "hash"), cut)) for cut in cuts])), f"ARRAY<{_KEY}>"
    )
    placed = with_computed(
        _collapse_hot(rows, keys, hot_rows), "range", _range_of(F.col("key"), firsts, count)
    )
    is_first = F.get(firsts, F.col("range")) == F.col("key")
    both = F.when(is_first, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    sent = placed.select("*", F.explode(both).alias("ahead"))
    target = F.when(F.col("ahead"), F.pmod(F.col("range") - 1, F.lit(count))).otherwise(F.col("range"))
    dealt = sent.withColumn("range", target).repartitionById(count, "range")
    ordered = dealt.sortWithinPartitions("range", "ahead", "key", "text")
    return ordered.select("range", "ahead", "doc_id", "text", "copies")


def edit(text: str, following: str) -> str:
    """``text`` whose last third is replaced by as much of the next text's beginning."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


class _Document:
    def __init__(self, doc_id, text: str, copies: int, signer: SpotSignatures):
        self.doc_id, self.text, self.copies = doc_id, text, copies
        self.signatures = signer(text)

    def beside(self, following: "_Document", signer: SpotSignatures, least: float, times: int):
        """A row of results; ``times`` says how many documents it stands for."""
        edited = edit(self.text, following.text)
        signatures = signer(edited)
        return (
            self.doc_id,
            len(self.text),
            sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            encode(self.signatures),
            encode(signatures),
            jaccard(self.signatures, signatures, least),
            jaccard(self.signatures, following.signatures, least),
            times,
        )

    def rows(self, following: "_Document", signer: SpotSignatures, least: float):
        yield self.beside(following, signer, least, 1)
        if self.copies > 1:
            # All copies but the last are followed by another copy.
            yield self.beside(self, signer, least, self.copies - 1)


def _neighbours(batches, signer: SpotSignatures, least: float):
    """Result rows of ordered ranges."""
    last, finished = None, None
    for batch in batches:
        columns = [batch.column(name) for name in ("range", "ahead", "doc_id", "text", "copies")]
        for row in zip(*columns):
            place, ahead, doc_id, text, copies = (value.as_py() for value in row)
            if place == finished:
                continue
            document = _Document(doc_id, text, copies, signer)
            if last is not None:
                yield from last.rows(document, signer, least)
            last = None if ahead else document
            finished = place if ahead else finished


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded bytes."""
    held, size = [], 0

    def batch():
        columns = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for row in rows:
        held.append(row)
        size += len(row[3]) + len(row[4])
        if len(held) >= _BATCH_ROWS or size >= _BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def compare_neighbours(
    documents: DataFrame,
    anchors: tuple[str, ...] = ANCHORS,
    chain: int = CHAIN,
    gap: int = GAP,
    least: float = MIN_LIKENESS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each document's fingerprint beside those of its edit and of the next document.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``; the edit is :func:`edit`.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_chars", pa.int64()),
            *[(name, pa.string()) for name in ("edited_sha256", "fingerprint", "edited_fingerprint")],
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
            ("times", pa.int64()),
        ]
    )

    def compare(batches):
        signer = _signer(anchors, chain, gap)
        yield from _batches(_neighbours(batches, signer, least), schema)

    found = _ordered(documents, hot_rows).mapInArrow(
        releasing(compare),
        "doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, fingerprint STRING, "
        "edited_fingerprint STRING, near_edited DOUBLE, near_next DOUBLE, times BIGINT",
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")
    return found.select("*", copies).drop("times", "copy")
