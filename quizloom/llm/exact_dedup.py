"""Exact deduplication by an extendible-hash index on shared files.

Hashes come first: a grouping of hashes alone finds those that occur more than once. A
directory of 2^depth slots points to buckets named by leading bits of the hash; it
doubles, splitting overfull buckets by one more bit, until every bucket holds at most
``capacity`` hashes. Texts move only if their hash is repeated: to the task that owns
their bucket, which walks the chain of each hash in byte order, compares neighbours byte
by byte and starts a new link where they differ. The index has one record per distinct
normalised text: hash, link in its chain, SHA-256 (of chained texts only), the smallest
doc_id that holds it and the number of rows that do.

Everything is DataFrame code. A text that a third of all rows hold is collapsed by each
task before it moves, and by ``SALTS`` tasks before its owner sees it. The scan leaves
out texts of unrepeated hashes by a bit table of fixed size, the only thing broadcast
besides the directory; texts that it lets through for nothing are chains of one row.

Defined results: NULL text is the empty text. A NULL doc_id is larger than any other
and is never the one that stays unless all its copies have none; it then stays as NULL. Rows
that repeat both doc_id and text are one document written twice: all of them carry the
same values. Other columns are passed through untouched; an empty table gives an empty
one.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizloom.llm.bits import may_be_among
from quizloom.llm.text import hide, single_spaced
from quizloom.operators.storage import materialise, new_folder

CAPACITY = 1 << 16
# Bounds the directory at 2^20 slots.
MAX_DEPTH = 20
# Tasks that share the copies of one text before its owner gets them.
SALTS = 8
_LAST = (1 << 63) - 1


@dataclass
class HashIndex:
    """``records`` on shared files and the ``directory`` that names their buckets."""

    records: DataFrame
    directory: DataFrame
    depth: int
    hash_of: Callable[[Column], Column]


def _prefix(h: Column, bits: int) -> Column:
    """The leading bits of a hash as a non-negative number."""
    return F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("bigint")


def grow_directory(
    hashes: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH
) -> tuple[DataFrame, int]:
    """``slot, bucket, bits`` for every non-empty slot, and the directory's depth.

    Starts from one bucket and doubles the directory while a bucket is overfull. Each
    doubling sums small slot counts; only the number of overfull buckets is read here.
    A bucket that is still overfull at ``max_depth`` bits stays one bucket; its records
    are processed by ranges of the full hash all the same.
    """
    counts = materialise(
        hashes.groupBy(_prefix(F.col("h"), max_depth).alias("fine")).agg(F.count("*").alias("n"))
    )
    open_slots = counts
    closed = None
    depth = 0
    while True:
        slot = F.shiftrightunsigned("fine", max_depth - depth)
        sizes = open_slots.groupBy(slot.alias("bucket")).agg(F.sum("n").alias("size"))
        full = sizes.filter((F.col("size") > capacity) & F.lit(depth < max_depth))
        done = sizes.join(full.select("bucket"), "bucket", "left_anti").select(
            "bucket", F.lit(depth).alias("bits")
        )
        closed = done if closed is None else closed.unionByName(done)
        if full.count() == 0:
            break
        open_slots = materialise(
            open_slots.withColumn("bucket", slot).join(full.select("bucket"), "bucket", "left_semi")
        ).drop("bucket")
        depth += 1
    # A bucket of fewer bits is the target of every slot that begins with its bits.
    copies = F.pow(F.lit(2), F.lit(depth) - F.col("bits")).cast("bigint")
    directory = closed.select(
        "bucket", "bits", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1)).alias("tail")
    ).select((F.col("bucket") * copies + F.col("tail")).alias("slot"), "bucket", "bits")
    return materialise(directory), depth


def _in_bucket(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """``rows`` with the ``bucket`` and ``bits`` of their slot."""
    return rows.withColumn("slot", _prefix(F.col("h"), depth)).join(
        F.broadcast(directory), "slot"
    ).drop("slot")


def _chains(placed: DataFrame) -> DataFrame:
    """A record per distinct text, made by the task that owns its bucket.

    A chain has at most ``SALTS`` rows a text. Chains of one row were no repeated hash.
    """
    owned = placed.repartition("bits", "bucket")
    chain = Window.partitionBy("bits", "bucket", "h")
    walk = chain.orderBy("norm")
    differs = ~F.col("norm").eqNullSafe(F.lag("norm").over(walk))
    walked = (
        owned.withColumn("total", F.sum("n").over(chain))
        .filter("total > 1")
        .withColumn("link", F.sum(differs.cast("int")).over(walk))
    )
    return walked.groupBy("bits", "bucket", "h", "link").agg(
        F.first("text_sha256").alias("text_sha256"),
        F.min("keep").alias("keep"),
        F.sum("n").alias("group_size"),
    )


def build_index(
    documents: DataFrame,
    capacity: int = CAPACITY,
    max_depth: int = MAX_DEPTH,
    hash_of: Callable[[Column], Column] = F.xxhash64,
) -> HashIndex:
    """Index of all distinct normalised texts of ``documents``."""
    spark = documents.sparkSession
    order = F.coalesce(F.col("doc_id"), F.lit(_LAST))
    texts = documents.select(order.alias("id"), single_spaced(F.col("text")).alias("norm"))
    rows = texts.withColumn("h", hash_of(F.col("norm")))
    counts = materialise(rows.groupBy("h").agg(F.min("id").alias("keep"), F.count("*").alias("n")))
    directory, depth = grow_directory(counts.select("h"), capacity, max_depth)
    collapsed = (
        may_be_among(rows, counts.filter("n > 1"))
        .groupBy(F.pmod("id", F.lit(SALTS)).alias("salt"), "h", "norm")
        .agg(F.min("id").alias("keep"), F.count("*").alias("n"))
        .withColumn("text_sha256", F.sha2("norm", 256))
    )
    chained = materialise(_chains(_in_bucket(collapsed, directory, depth)))
    single = _in_bucket(counts.filter("n = 1"), directory, depth).select(
        "bits",
        "bucket",
        "h",
        F.lit(1).cast("bigint").alias("link"),
        F.lit(None).cast("string").alias("text_sha256"),
        "keep",
        F.col("n").alias("group_size"),
    )
    records = chained.unionByName(single)
    path = new_folder(spark, "hash-index")
    placed = records.repartition("bits", "bucket").sortWithinPartitions("bits", "bucket", "h", "link")
    placed.write.parquet(path)
    stored = spark.read.schema(records.schema).parquet(path)
    return HashIndex(stored, directory, depth, hash_of)


def mark_copies(documents: DataFrame, index: HashIndex) -> DataFrame:
    """``documents`` with keep_id, group_size, kept and text_sha256.

    Rows look up their link by hash and SHA-256; those without a link of several rows
    have no copies. The join is a plain one: Spark splits the partition of a text that
    very many rows hold.
    """
    documents, show = hide(documents, "doc_id", "text")
    norm = single_spaced(F.col("text"))
    found = index.records.filter("group_size > 1").select(
        F.col("h").alias("_h"), F.col("text_sha256").alias("_sha"), "keep", F.col("group_size").alias("_n")
    )
    rows = documents.select("*", index.hash_of(norm).alias("_h"), F.sha2(norm, 256).alias("_sha"))
    own = F.when(F.col("_n").isNull(), F.col("doc_id"))
    keep = own.otherwise(F.when(F.col("keep") != _LAST, F.col("keep")))
    marked = (
        rows.join(found, ["_h", "_sha"], "left")
        .withColumn("keep_id", keep)
        .withColumn("group_size", F.coalesce("_n", F.lit(1).cast("bigint")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .withColumn("text_sha256", F.col("_sha"))
    )
    return show(marked, "keep_id", "group_size", "kept", "text_sha256")


def exact_dedup(documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Only the rows that stay, with the input's columns."""
    hidden, show = hide(documents, "doc_id", "text")
    return show(mark_copies(hidden, build_index(documents, capacity)).filter("kept"))
