"""A broadcast filter of fixed size for rows whose hash may be among given ones."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The bit table has at most 2^20 words of 64 bits.
WORD_BITS = 20


def may_be_among(rows: DataFrame, hashes: DataFrame, name: str = "h") -> DataFrame:
    """The rows whose hash ``name`` is among ``hashes``, and a few others.

    The table has a word per value of the hash's low bits, so its size is bounded whatever
    the number of hashes. Past some ten million of them it lets ever more rows through;
    an exact step must follow.
    """
    word = F.col(name).bitwiseAND((1 << WORD_BITS) - 1)
    bit = F.shiftright(name, WORD_BITS).bitwiseAND(63).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = hashes.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("mask"))
    found = rows.withColumn("word", word).join(F.broadcast(words), "word")
    return found.filter(F.getbit("mask", bit) == 1).drop("word", "mask")
