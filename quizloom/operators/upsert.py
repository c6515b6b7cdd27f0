"""Keyed upserts: the last write of a key wins."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from quizloom.operators.storage import child_folders, is_complete


def last_rows(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key: the one with the highest load order.

    A grouping rather than a window, so each task reduces its rows to one per key
    before the shuffle and a key with very many rows stays cheap.
    """
    others = [c for c in df.columns if c != key]
    latest = F.max_by(F.struct(*others), order).alias("_row")
    return df.groupBy(key).agg(latest).select(key, "_row.*").select(*df.columns)


def last_fields(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key: for each field the last value that is not missing."""
    others = [c for c in df.columns if c != key]
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in others]
    return df.groupBy(key).agg(*latest).select(*df.columns)


def merge_rows(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows replace stored rows of the same key. Keys unique on both sides."""
    return _merge(stored, incoming, key, whole_rows=True)


def merge_fields(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming fields replace stored fields; missing ones leave the stored value."""
    return _merge(stored, incoming, key, whole_rows=False)


def _merge(stored, incoming, key, whole_rows) -> DataFrame:
    old = stored.select(key, F.struct(*stored.columns).alias("_old"))
    new = incoming.select(key, F.struct(*stored.columns).alias("_new"))
    both = old.join(new, key, "full")
    if whole_rows:
        return both.select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")

    def merged(c: str) -> Column:
        was, now = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        if isinstance(stored.schema[c].dataType, MapType):
            both_maps = F.map_zip_with(was, now, lambda _, a, b: F.coalesce(b, a))
            return F.coalesce(both_maps, now, was).alias(c)
        return F.coalesce(now, was).alias(c)

    return both.select(*[merged(c) for c in stored.columns])


def upsert_counts(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """One row ``upserted, modified``: new keys, and stored keys whose fields change.

    Counted per final key, so several documents for one key count once.
    """
    old = stored.select(key, F.struct(*stored.columns).alias("_old"))
    new = incoming.select(key, F.struct(*stored.columns).alias("_new"))
    changed = F.lit(False)
    for c in stored.columns:
        was, now = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        if isinstance(stored.schema[c].dataType, MapType):
            differs = F.exists(
                F.map_entries(now), lambda e: ~e["value"].eqNullSafe(F.element_at(was, e["key"]))
            )
        else:
            differs = ~now.eqNullSafe(was)
        changed |= now.isNotNull() & F.coalesce(differs, F.lit(True))
    known = F.col("_old").isNotNull()
    return new.join(old, key, "left").agg(
        F.count_if(~known).alias("upserted"), F.count_if(known & changed).alias("modified")
    )


def read_store(spark, path: str, schema) -> DataFrame:
    """Newest complete version of a store, empty if there is none."""
    version = _latest(spark, path)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/version={version}")


def write_store(df: DataFrame, path: str) -> str:
    """Write the next version of a store; readers keep the one they opened.

    A version without a success marker is never read, so a job that dies half-way
    leaves the store as it was.
    """
    taken = _versions(df.sparkSession, path)
    target = f"{path}/version={max(taken, default=0) + 1}"
    df.write.mode("errorifexists").parquet(target)
    return target


def _versions(spark, path) -> list[int]:
    names = child_folders(spark, path)
    return [int(n.split("=", 1)[1]) for n in names if n.startswith("version=")]


def _latest(spark, path) -> int | None:
    done = [v for v in _versions(spark, path) if is_complete(spark, f"{path}/version={v}")]
    return max(done, default=None)
