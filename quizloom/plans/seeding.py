"""Loading of taxonomies and prompt templates into keyed stores."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom import schemas
from quizloom.functions.taxonomy import leaf_id
from quizloom.operators.storage import materialise, scratch
from quizloom.operators.upsert import (
    last_fields,
    last_rows,
    merge_fields,
    merge_rows,
    read_store,
    upsert_counts,
    write_store,
)
from quizloom.sources.documents import (
    accepted,
    one_row_or_error,
    read_prompts,
    read_taxonomies,
    rejected,
)

LOAD_ORDER = ["format_rank", "path", "cat_pos", "item_pos"]


def flatten_leaves(taxonomies: DataFrame, legacy: bool = False) -> DataFrame:
    """One stored leaf per taxonomy item, with its load order in ``load_order``.

    Takes ``path, format_rank, doc`` rows; each category and item is exploded where
    it is read.
    """
    items = taxonomies.select(
        "path",
        "format_rank",
        F.col("doc.domain").alias("domain"),
        F.posexplode("doc.categories").alias("cat_pos", "category", "items"),
    ).select("*", F.posexplode("items").alias("item_pos", "item"))
    domain, category, topic = F.col("domain"), F.col("category"), F.col("item.topic")
    return items.select(
        "domain",
        "category",
        topic.alias("topic"),
        F.col("item.difficulty").alias("difficulty"),
        leaf_id(domain, category, topic, legacy).alias("leaf_id"),
        F.struct(*LOAD_ORDER).alias("load_order"),
    )


def upsert_leaves(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored leaves after the load; ``incoming`` carries ``load_order``."""
    latest = last_rows(
        incoming.select(*schemas.STORED_LEAF.names, "load_order"), "leaf_id", F.col("load_order")
    )
    return merge_rows(stored, latest.drop("load_order"), "leaf_id")


def seed_taxonomies(
    spark: SparkSession, folder: str, store: str, legacy: bool = False
) -> dict[str, int]:
    """Load a folder of taxonomies; returns the number of leaves processed.

    Every document and leaf is checked before anything is written, so a faulty file
    changes nothing.
    """
    with scratch(spark):
        docs = materialise(read_taxonomies(spark, folder))
        _raise_if_any(rejected(docs), "unreadable taxonomy")
        leaves = materialise(flatten_leaves(accepted(docs), legacy))
        lacking = leaves.filter(F.col("topic").isNull() | F.col("difficulty").isNull())
        _raise_if_any(lacking.select("load_order.path"), "leaf without topic or difficulty")
        processed = leaves.count()
        if processed:
            stored = read_store(spark, store, schemas.STORED_LEAF)
            write_store(upsert_leaves(stored, leaves), store)
        return {"processed": processed}


def _raise_if_any(rows: DataFrame, what: str) -> None:
    first = rows.first()
    if first is not None:
        path, *rest = first
        why = " ".join(str(r) for r in rest if r is not None)
        raise ValueError(f"{what} in {path}" + (f": {why}" if why else ""))


def pipeline_leaves(stored: DataFrame) -> DataFrame:
    """Stored leaves as ``id, label, difficulty``."""
    return stored.select(
        F.col("leaf_id").alias("id"), F.col("topic").alias("label"), "difficulty"
    )


def read_leaves(spark: SparkSession, store: str) -> DataFrame:
    return pipeline_leaves(read_store(spark, store, schemas.STORED_LEAF))


def valid_prompts(prompts: DataFrame) -> DataFrame:
    """Templates that have an id. Everything else about them is checked where it is used."""
    return prompts.filter(F.col("prompt_id").isNotNull())


def latest_prompts(prompts: DataFrame) -> DataFrame:
    """One template per id; of several, each field's last value counts."""
    names = [c for c in schemas.PROMPT.names if c != "extra"]
    latest = last_fields(prompts.select(*names, "load_order"), "prompt_id", F.col("load_order"))
    latest = latest.drop("load_order")
    if "extra" not in prompts.columns:
        return latest
    fields = prompts.select("prompt_id", "load_order", F.explode("extra").alias("name", "value"))
    last = fields.filter(F.col("value").isNotNull()).groupBy("prompt_id", "name")
    last = last.agg(F.max_by("value", "load_order").alias("value"))
    extra = last.groupBy("prompt_id").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("extra")
    )
    return latest.join(extra, "prompt_id", "left")


def seed_prompts(
    spark: SparkSession, folder: str, store: str, rejects: str | None = None
) -> dict[str, int]:
    """Load a folder of templates; returns upserted, modified and skipped counts.

    Documents are stored with all their fields. Files that do not parse and templates
    without an id are skipped; ``rejects`` names a folder for a table of them, with path,
    place and reason of each.
    """
    with scratch(spark):
        docs = read_prompts(spark, folder)
        order = F.struct("format_rank", "path").alias("load_order")
        found = materialise(docs.select("doc.*", order, "path", "problem"))
        bad = rejected(found)
        if rejects is not None:
            bad.write.mode("overwrite").parquet(rejects)
        skipped = bad.count()
        valid = valid_prompts(accepted(found).drop("path"))
        incoming = materialise(latest_prompts(valid))
        stored = read_store(spark, store, schemas.PROMPT)
        counts = upsert_counts(stored, incoming, "prompt_id").first().asDict()
        if counts["upserted"] or counts["modified"]:
            write_store(merge_fields(stored, incoming, "prompt_id"), store)
        return {**counts, "skipped": skipped}


def read_prompt_store(spark: SparkSession, store: str) -> DataFrame:
    return read_store(spark, store, schemas.PROMPT)


def get_prompt(spark: SparkSession, store: str, prompt_id: str) -> DataFrame:
    """The template with the id as a one-row table; raises if it is unknown."""
    return one_row_or_error(read_prompt_store(spark, store), "prompt_id", prompt_id)
