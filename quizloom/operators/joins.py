"""Joins that stay balanced when one key holds a large share of the rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of a table that may be broadcast.
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 100_000
# Parts over which rows without a key are spread; they have no partner anywhere.
KEYLESS_PARTS = 1 << 12


def fits(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """True if the rows, written out, have at most that many bytes. Summed in parallel."""
    width = F.octet_length(F.to_json(F.struct("*")))
    return (df.agg(F.sum(width)).first()[0] or 0) <= limit


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join of skewed ``facts`` with a ``lookup`` whose keys are unique.

    Keys with more than ``hot_rows`` facts are split into as many parts as they have
    multiples of it, by a hash of ``spread_by``; their lookup row is copied once per
    part. Facts without a key are spread as well. All other keys join as they are.
    ``facts`` is read more than once, so pass stored rows. Spark itself splits hot keys
    only of joins whose both sides it has just shuffled; use this where a side comes
    partitioned already.
    """
    parts = (
        facts.groupBy(key)
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(key, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts"))
    )
    if fits(parts):
        parts = F.broadcast(parts)
    split_facts = (
        facts.join(parts, key, "left")
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(KEYLESS_PARTS)))
            .when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(spread_by), F.col("_parts")))
            .otherwise(0),
        )
        .drop("_parts")
    )
    split_lookup = (
        lookup.join(parts, key, "left")
        .withColumn(
            "_salt",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)),
        )
        .withColumn("_salt", F.col("_salt").cast("bigint"))
        .drop("_parts")
    )
    return split_facts.join(split_lookup, [key, "_salt"], how).drop("_salt")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    max_broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join with a lookup of unique keys: broadcast if its bytes are few, else salted."""
    if fits(lookup, max_broadcast_bytes):
        return facts.join(F.broadcast(lookup), key, how)
    return salted_join(facts, lookup, key, spread_by, how)
