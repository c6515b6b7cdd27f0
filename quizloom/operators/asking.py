"""Questions to models that were answered in earlier runs are not asked again."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.functions.journal import asked_digest
from quizloom.operators.columns import free_name


def ask(rows: DataFrame, model: Callable, asked: list[Column], out: str) -> DataFrame:
    """Add the model's ``STRUCT<raw, error>`` on ``asked`` as column ``out``.

    With a journal, rows are joined with its replies first; the model sees NULL, which is
    never sent, where there is one.
    """
    journal = getattr(model, "journal", None)
    if journal is None:
        return rows.withColumn(out, model(*asked))
    known = journal.replies(rows.sparkSession).filter(F.col("model") == model.name)
    digest, raw = (free_name([*rows.columns, out], name) for name in ("_digest", "_known"))
    known = known.select(F.col("digest").alias(digest), F.col("raw").alias(raw))
    joined = rows.withColumn(digest, asked_digest(*asked)).join(known, digest, "left")
    reply = model(F.when(F.col(raw).isNull(), asked[0]), *asked[1:])
    kept = F.struct(F.col(raw).alias("raw"), F.lit(None).cast("string").alias("error"))
    found = joined.withColumn(out, reply)
    return found.withColumn(out, F.when(F.col(raw).isNotNull(), kept).otherwise(F.col(out))).drop(digest, raw)


def known_of_panel(rows: DataFrame, journal, asked: Column, models: list[str], out: str) -> DataFrame:
    """Add ``out``, an array of the ``model, raw`` pairs that earlier runs have for a prompt."""
    known = journal.replies(rows.sparkSession).filter(F.col("model").isin(models))
    pairs = known.groupBy(F.col("digest").alias("_digest")).agg(
        F.collect_list(F.struct("model", "raw")).alias(out)
    )
    return rows.withColumn("_digest", asked_digest(asked)).join(pairs, "_digest", "left").drop("_digest")
