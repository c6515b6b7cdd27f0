"""Join of near-duplicate texts: MinHash bands, then exact Jaccard on all word n-grams.

Texts become sets of hashed word n-grams. Documents with equal sets form one class and
are joined through one member. MinHash signatures of the members are cut into bands;
members with an equal band share a bucket. How many bands of how many rows follows from
the recall asked for at the similarity threshold. Members of a bucket are compared on
their full sets.

What is shuffled are band hashes, once each, and the texts of those documents that share a
bucket with another; a text is a third of its set, so sets are made again where they are
compared. Bit tables of fixed size leave out nearly all other texts and bands, as long as
there are at most some ten million such documents or buckets; past that they let
more and more through to the joins that follow. Buckets with the same members
count once. No pair is ever a row:
a task compares the members of a bucket in memory and returns one row per member, its
number of links and a neighbour chain to its cluster; a pair is counted only in the
first band that both share. A bucket with more than ``BLOCK_MEMBERS`` members, or with
sets of more than ``BLOCK_BYTES``, is compared block by block in several tasks, so nothing
is left out and no task holds an unbounded group. Chains are merged into classes by alternating star steps.

Defined results: words are runs of other characters than white space; a text with fewer
words than ``n`` has all its words as its only n-gram; texts without words (and NULL)
have the empty set, are copies of each other and resemble nothing else. A NULL doc_id is larger than any other. Rows that repeat both doc_id and
text are copies of each other.
"""

import hashlib
import math
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.bits import may_be_among
from quizloom.llm.tasks import releasing
from quizloom.llm.text import WORD_RE, hide
from quizloom.operators.storage import materialise

N = 5
SIMILARITY = 0.8
RECALL = 0.99995
# Hash functions that a signature may have.
MAX_HASHES = 384
BLOCK_MEMBERS = 2048
# Of sets; blocks are drawn by a hash and hold this much on average.
BLOCK_BYTES = 32 << 20
_LAST = (1 << 63) - 1
# A bucket's number: its band, then this many bits of the band's hash.
_HASH_BITS = 57
_WORD_CACHE = 1 << 17
_MIX = np.uint64(0x9E3779B97F4A7C15)


def choose_bands(similarity: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Bands and rows: the longest bands that reach the recall with that many hashes.

    A pair is found if one band is equal: 1 - (1 - s^rows)^bands. Longer bands let
    fewer dissimilar pairs through.
    """
    best = None
    for rows in range(1, max_hashes + 1):
        equal = similarity**rows
        if equal < 1e-12:
            break
        bands = math.ceil(math.log(1 - recall) / math.log1p(-equal)) if equal < 1 else 1
        if bands * rows <= max_hashes and bands <= 63:
            best = (bands, rows)
    if best is None:
        raise ValueError("no bands reach that recall with so few hashes")
    return best


class GramHasher:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""

    def __init__(self, n: int):
        self.n = n
        self._known: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = WORD_RE.findall(text)
        known = self._known
        if len(known) > _WORD_CACHE:
            known.clear()
        for word in set(words):
            if word not in known:
                digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8)
                known[word] = int.from_bytes(digest.digest(), "little")
        codes = np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))
        width = min(self.n, len(codes))
        if not width:
            return codes
        grams = codes[: len(codes) - width + 1].copy()
        for i in range(1, width):
            grams *= _MIX
            grams += codes[i : len(codes) - width + 1 + i]
        grams ^= grams >> np.uint64(31)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(29)
        return np.unique(grams)


class MinHasher:
    """Bucket numbers of a set, one per band. The hash functions are fixed by a seed."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        self.bands, self.rows = bands, rows
        random = np.random.default_rng(seed)
        numbers = random.integers(0, 1 << 32, (2, bands * rows), dtype=np.uint64)
        self._factor = (numbers[0] | np.uint64(1)).astype(np.uint32)[:, None]
        self._shift = numbers[1].astype(np.uint32)[:, None]
        self._weight = random.integers(0, 1 << 63, (1, rows), dtype=np.uint64) | np.uint64(1)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(self.bands * self.rows, np.iinfo(np.uint32).max, dtype=np.uint32)
        high = (grams >> np.uint64(32)).astype(np.uint32)[None, :]
        for at in range(0, high.shape[1], 512):
            hashed = self._factor * high[:, at : at + 512] + self._shift
            np.minimum(least, hashed.min(axis=1), out=least)
        rows = least.reshape(self.bands, self.rows).astype(np.uint64) + np.uint64(1)
        code = np.zeros(self.bands, dtype=np.uint64)
        for row in range(self.rows):
            code = (code ^ (rows[:, row] * self._weight[0, row])) * _MIX
            code ^= code >> np.uint64(29)
        band = np.arange(self.bands, dtype=np.uint64) << np.uint64(_HASH_BITS)
        return (band | (code >> np.uint64(64 - _HASH_BITS))).astype(np.int64)


def _text_key() -> Column:
    return F.md5(F.coalesce("text", F.lit("")))


def _order() -> Column:
    return F.coalesce("doc_id", F.lit(_LAST))


def sketches(documents: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``uid, id, key, digest, size, buckets``: a stored row per document.

    ``digest`` stands for the n-gram set, ``size`` counts its members. The empty set is in
    no bucket.
    """

    def sketch(batches):
        grams_of, minhash = GramHasher(n), MinHasher(bands, rows)
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            uids, digests, sizes, buckets = array("q"), [], array("q"), []
            for text in batch.column("text"):
                grams = grams_of(text.as_py() or "")
                uids.append(uid)
                uid += 1
                digests.append(hashlib.md5(grams.tobytes()).digest())
                sizes.append(len(grams))
                buckets.append(minhash(grams) if len(grams) else np.empty(0, dtype=np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "uid": pa.array(np.asarray(uids, dtype=np.int64)),
                    "id": batch.column("id"),
                    "key": batch.column("key"),
                    "digest": pa.array(digests, pa.binary()),
                    "size": pa.array(np.asarray(sizes, dtype=np.int64)),
                    "buckets": pa.array(buckets, pa.list_(pa.int64())),
                }
            )

    texts = documents.select(_order().alias("id"), _text_key().alias("key"), "text")
    schema = "uid BIGINT, id BIGINT, key STRING, digest BINARY, size BIGINT, buckets ARRAY<BIGINT>"
    return materialise(texts.mapInArrow(releasing(sketch), schema))


def _may_share(rows: DataFrame, others: DataFrame, name: str) -> DataFrame:
    """The rows whose column ``name`` may be among that of ``others``."""
    hashed = F.xxhash64(name).alias("h")
    return may_be_among(rows.select("*", hashed), others.select(hashed)).drop("h")


def shared_buckets(rows: DataFrame) -> DataFrame:
    """``uid, bucket, members, grams`` of buckets with several members, one per member list.

    ``rows`` are ``uid, size, bucket``; ``grams`` sums the sizes of a bucket's members.
    Lists are told apart by their length and two sums of member hashes. Of buckets with
    equal lists the lowest band stays, as it is there that their pairs are counted.
    """
    counted = rows.groupBy("bucket").agg(F.count("*").alias("members"), F.sum("size").alias("grams"))
    several = materialise(counted.filter("members > 1"))
    placed = _may_share(rows.drop("size"), several, "bucket")
    together = materialise(placed.join(several, "bucket"))
    lists = together.groupBy("bucket", "members").agg(
        F.bit_xor(F.xxhash64("uid")).alias("first"),
        F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("second"),
    )
    chosen = lists.groupBy("members", "first", "second").agg(F.min("bucket").alias("bucket"))
    return materialise(together.join(chosen.select("bucket"), "bucket", "left_semi"))


def _compare(group: dict, similarity: float):
    """Links between the members of one bucket or of two of its blocks."""
    sets = group["grams"]
    count = len(sets)
    band = group["bucket"] >> _HASH_BITS
    earlier = np.array(group["earlier"], dtype=np.int64)
    size = np.array([len(s) for s in sets])
    block = np.array(group["block"])
    crossing = group["low"] != group["high"]
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    start = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(len(flat), dtype=np.int32)
    links = np.zeros(count, dtype=np.int64)
    parent = np.arange(count)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(count - 1):
        rest = slice(i + 1, count)
        small, large = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
        wanted = small >= similarity * large - 1e-9
        if crossing:
            wanted &= block[rest] != block[i]
        if band:
            wanted &= ~(earlier[rest] == earlier[i]).any(axis=1)
        others = np.flatnonzero(wanted) + i + 1
        if not len(others):
            continue
        mark[flat[start[i] : start[i + 1]]] = 1
        lengths = size[others]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat(start[others] - (ends - lengths), lengths)
        common = np.add.reduceat(mark[flat[places]], ends - lengths)
        mark[flat[start[i] : start[i + 1]]] = 0
        union = size[i] + lengths - common
        near = others[common >= similarity * union - 1e-9]
        links[i] += len(near)
        links[near] += 1
        for j in near:
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    linked = np.flatnonzero(links)
    uids = np.array(group["uid"], dtype=np.int64)
    roots = np.array([root(i) for i in linked], dtype=np.int64)
    return uids[linked], uids[roots] if len(roots) else uids[:0], links[linked]


_GROUP = ("bucket", "low", "high")
_MEMBER = ("uid", "block", "earlier", "text")
_LINKS = pa.schema([("uid", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def _compare_groups(n: int, similarity: float):
    """Rows come sorted by group; a group may go on in the next batch.

    Sets are made here from the texts, so only those of one group are held.
    """

    def result(group):
        uid, root, links = _compare(group, similarity)
        return pa.RecordBatch.from_pydict({"uid": uid, "root": root, "links": links}, schema=_LINKS)

    def compare(batches):
        grams_of, group = GramHasher(n), None
        done, rows = [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*_GROUP, *_MEMBER)]
            for row in zip(*columns):
                if group is None or row[:3] != tuple(group[c] for c in _GROUP):
                    if group is not None:
                        done.append(result(group))
                        rows += done[-1].num_rows
                        if rows > 10_000:
                            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                            done, rows = [], 0
                    group = dict(zip(_GROUP, row[:3])) | {c: [] for c in (*_MEMBER[:-1], "grams")}
                for name, value in zip(_MEMBER[:-1], row[3:]):
                    group[name].append(value)
                group["grams"].append(grams_of(row[-1]))
        if group is not None:
            done.append(result(group))
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()

    return compare


def _member_texts(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``uid, text, buckets`` of the wanted documents, repeated rows of one once.

    Wanted documents have different sets, so none shares both id and key with another.
    """
    texts = documents.select(_order().alias("id"), _text_key().alias("key"), "text")
    row_hash = F.xxhash64("id", "key")
    texts = may_be_among(texts.withColumn("h", row_hash), wanted.select(row_hash.alias("h")))
    found = texts.join(wanted, ["id", "key"]).dropDuplicates(["id", "key"])
    return found.select("uid", "text", "buckets")


def deal(shared: DataFrame, block_members: int, block_bytes: int) -> DataFrame:
    """``bucket, low, high, block, uid``: each member once per pair of blocks it is in."""
    most = F.greatest(F.col("members") / block_members, F.col("grams") * 8 / block_bytes)
    blocks = F.least(F.ceil(most), F.col("members")).cast("int")
    block = F.pmod(F.xxhash64("uid"), blocks).cast("int")
    return (
        shared.withColumn("blocks", blocks)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "uid",
        )
    )


def find_links(
    documents: DataFrame,
    members: DataFrame,
    n: int,
    similarity: float,
    block_members: int,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``uid, root, links`` per member and bucket; a stored table.

    ``members`` are ``uid, id, key, size, buckets`` of documents with different n-gram sets.
    """
    shared = shared_buckets(members.select("uid", "size", F.explode("buckets").alias("bucket")))
    uids = shared.select("uid").distinct()
    wanted = materialise(_may_share(members.drop("size"), shared, "uid").join(uids, "uid", "left_semi"))
    texts = materialise(_member_texts(documents, wanted))
    dealt = deal(shared, block_members, block_bytes)
    # Only the bands before a group's own are looked at there.
    band = F.shiftright("bucket", _HASH_BITS).cast("int")
    earlier = F.slice("buckets", F.lit(1), band).alias("earlier")
    together = dealt.join(texts, "uid").select(*_GROUP, "uid", "block", earlier, "text")
    sorted_rows = together.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "uid")
    compared = sorted_rows.mapInArrow(
        releasing(_compare_groups(n, similarity)), "uid BIGINT, root BIGINT, links BIGINT"
    )
    return materialise(compared)


def connected(edges: DataFrame) -> DataFrame:
    """``uid, label``: the smallest uid that each node of ``a, b`` is connected to.

    Alternating large-star and small-star steps. A step reads each node's smallest
    neighbour and hands it to the others, by a grouping and a join. The loop reads
    counts only; every round's edges are stored.
    """
    edges = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now, before = materialise(edges.distinct()), None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if before == mark:
            break
        before = mark
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: larger neighbours go to the smallest of the neighbourhood.
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.filter("a <> b").distinct())
        # Small star: smaller neighbours and the node itself go to the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b")))
        now = materialise(small.filter("a <> b").distinct())
    return now.select(F.col("a").alias("uid"), F.col("b").alias("label"))


def near_duplicates(
    documents: DataFrame,
    n: int = N,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    block_members: int = BLOCK_MEMBERS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies, kept`` and ``key``, a row per document.

    ``class_id`` is the smallest doc_id among all documents that links connect,
    ``n_copies`` the number of documents with the same n-gram set, ``n_links`` the
    number of different other sets that are similar enough. ``kept`` marks one document
    of each class (repeated rows of it all carry the mark).
    """
    bands, rows = choose_bands(similarity, recall)
    sketched = sketches(documents.select("doc_id", "text"), n, bands, rows)
    same = materialise(
        sketched.groupBy("digest").agg(
            F.min("uid").alias("uid"),
            F.min(F.struct("id", "key")).alias("first"),
            F.count("*").alias("n_copies"),
        )
    )
    members = sketched.join(same.select("uid"), "uid", "left_semi")
    members = materialise(members.select("uid", "id", "key", "size", "buckets"))
    found = find_links(documents, members, n, similarity, block_members, block_bytes)
    links = found.groupBy("uid").agg(F.sum("links").alias("n_links"))
    labels = connected(found.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    classes = (
        same.join(labels, "uid", "left")
        .join(links, "uid", "left")
        .withColumn("label", F.coalesce("label", "uid"))
        .withColumn("n_links", F.coalesce("n_links", F.lit(0)))
    )
    classes = materialise(classes)
    # Of a class's documents with its smallest doc_id, that with the smallest text key.
    firsts = classes.groupBy("label").agg(F.min("first").alias("first"))
    classes = classes.drop("first").join(firsts, "label").select(
        "digest",
        F.col("first.id").alias("class_id"),
        F.col("first.key").alias("best"),
        "n_links",
        "n_copies",
    )
    joined = sketched.select("id", "key", "digest").join(classes, "digest")
    return joined.select(
        F.when(F.col("id") != _LAST, F.col("id")).alias("doc_id"),
        F.when(F.col("class_id") != _LAST, F.col("class_id")).alias("class_id"),
        "n_links",
        "n_copies",
        ((F.col("id") == F.col("class_id")) & (F.col("key") == F.col("best"))).alias("kept"),
        "key",
    )


def near_dedup(documents: DataFrame, **settings) -> DataFrame:
    """Only one document of each class, with the input's columns.

    Repeated rows of the document that stays count once.
    """
    documents, show = hide(documents, "doc_id", "text")
    found = near_duplicates(documents, **settings).filter("kept")
    stay = found.select(_order().alias("_id"), F.col("key").alias("_key")).distinct()
    rows = documents.withColumn("_id", _order()).withColumn("_key", _text_key())
    kept = rows.join(stay, ["_id", "_key"])
    return show(kept.dropDuplicates(["_id", "_key"]))
