"""Dense row numbers without gathering all rows in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quizloom.operators.ranges import cut_ranges
from quizloom.operators.storage import materialise

BUCKET_WIDTH = 1 << 8
# Bits of a bucket number that are summed up in one group.
_GROUP_BITS = 12
# Rows that a bucket of a shuffle should hold.
SHUFFLE_ROWS = 1 << 12


def number_by_bucket(
    df: DataFrame, bucket: Column, order_by: list, out: str, max_bucket: int
) -> DataFrame:
    """Number rows 0, 1, 2, ... in the order of (bucket, order_by).

    ``bucket`` must be a number in 0..max_bucket that rises with the wanted order. A
    row's number is its place in the bucket plus the sizes of all lower buckets. Rows
    move once, to their bucket; everything else works on one row per bucket.
    """
    # Never NULL, so that the joins below add no filters of their own to the uses of
    # ``sizes`` and Spark computes it once.
    keyed = df.withColumn("_bucket", F.coalesce(bucket.cast("bigint"), F.lit(0)))
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_by)) - 1
    return (
        keyed.withColumn("_place", place)
        .join(_starts(sizes, max_bucket), "_bucket")
        .withColumn(out, F.col("_start") + F.col("_place"))
        .drop("_bucket", "_place", "_start")
    )


def _starts(sizes: DataFrame, max_bucket: int) -> DataFrame:
    """``_bucket, _start``: the number of rows in all lower buckets.

    Buckets are summed in groups of 4,096 neighbours and the groups in turn, so no
    task ever orders more than one group, however many buckets there are.
    """
    window = Window.orderBy("_bucket")
    if max_bucket >> _GROUP_BITS:
        sizes = sizes.withColumn("_group", F.shiftright("_bucket", _GROUP_BITS))
        window = Window.partitionBy("_group").orderBy("_bucket")
    lower = F.sum("_rows").over(window.rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("_start", F.coalesce(lower, F.lit(0)))
    if not max_bucket >> _GROUP_BITS:
        return starts.select("_bucket", "_start")
    groups = sizes.groupBy(F.col("_group").alias("_bucket")).agg(F.sum("_rows").alias("_rows"))
    bases = _starts(groups, max_bucket >> _GROUP_BITS).select(
        F.col("_bucket").alias("_group"), F.col("_start").alias("_base")
    )
    return starts.join(bases, "_group").select(
        "_bucket", (F.col("_base") + F.col("_start")).alias("_start")
    )


def dense_ids(
    df: DataFrame, key: str, out: str, max_key: int | None = None, width: int = BUCKET_WIDTH
) -> DataFrame:
    """Dense 0-based ids in the order of a unique, non-negative integer key.

    A bucket is a range of ``width`` key values and so holds at most ``width`` rows,
    whatever the data; keys may be sparse. ``max_key`` saves a pass over ``df`` where
    an upper bound of the keys is known or cheaper to find elsewhere.
    """
    if max_key is None:
        max_key = df.agg(F.max(key)).first()[0] or 0
    bucket = F.expr(f"`{key}` div {width}")
    return number_by_bucket(df, bucket, [F.col(key)], out, max_key // width)


# Bytes of a table with one row per scan split that may be broadcast.
SPLIT_TABLE_BYTES = 128 << 20
SPLITS_PER_RANGE = 1 << 12


def row_positions(df: DataFrame, out: str) -> DataFrame:
    """Dense 0-based ids by file path and place in the file, for files without an id column.

    ``df`` must be a scan of files. Spark packs splits into tasks by size, so a row's
    running number in its task is taken relative to the first of its split, and splits
    are ordered by path and offset. The input is scanned twice, the first time without
    its columns. Rows are not shuffled as long as the table of splits, a path and three
    numbers each, is small enough to be broadcast; its size is checked. Should the second
    scan cut the files otherwise than the first, it fails.
    """
    split = [
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    ]
    numbered = df.select("*", *split, F.monotonically_increasing_id().alias("_running"))
    splits = numbered.groupBy("_path", "_block").agg(
        F.count("*").alias("_rows"), F.min("_running").alias("_first")
    )
    splits = materialise(splits)
    # A window over each range of splits, on top of the rows in all lower ranges.
    ranges = cut_ranges(splits, ["_path", "_block"], SPLITS_PER_RANGE, F.col("_rows"))
    ranged = splits.withColumn("_range", ranges.number())
    before = Window.partitionBy("_range").orderBy("_path", "_block")
    lower = F.sum("_rows").over(before.rowsBetween(Window.unboundedPreceding, -1))
    starts = ranged.select(
        "_path",
        "_block",
        "_first",
        (ranges.start(F.col("_range")) + F.coalesce(lower, F.lit(0))).alias("_start"),
    )
    size = splits.agg(F.sum(F.octet_length("_path") + 24)).first()[0] or 0
    if size <= SPLIT_TABLE_BYTES:
        starts = F.broadcast(starts)
    changed = F.raise_error(F.concat(F.lit("other splits than before of "), F.col("_path")))
    start = F.coalesce("_start", changed.cast("bigint"))
    return (
        numbered.join(starts, ["_path", "_block"], "left")
        .withColumn(out, start + F.col("_running") - F.col("_first"))
        .drop("_path", "_block", "_running", "_first", "_start")
    )


def shuffle_key(seed: int | str, key: Column) -> Column:
    """Hash that orders rows as if shuffled: fixed by seed and key alone."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def shuffled_positions(
    df: DataFrame, seed: int | str, key: Column, out: str = "position", digits: int | None = None
) -> DataFrame:
    """Add each row's 0-based position in a seeded shuffle of all rows.

    ``key`` must be unique. Hash prefixes of so many ``digits`` split the rows into even
    buckets, so the order is global without a global sort; without ``digits`` their
    number follows from a count of the rows.
    """
    if digits is None:
        digits = 1
        buckets = df.count() // SHUFFLE_ROWS
        while 16**digits < buckets:
            digits += 1
    hashed = df.withColumn("_shuffle", shuffle_key(seed, key)).withColumn("_key", key)
    bucket = F.conv(F.substring("_shuffle", 1, digits), 16, 10)
    order = [F.col("_shuffle"), F.col("_key")]
    numbered = number_by_bucket(hashed, bucket, order, out, 16**digits - 1)
    return numbered.drop("_shuffle", "_key")
