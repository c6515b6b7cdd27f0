"""Toxicity scores from a character n-gram classifier with naive Bayes scaling.

Every character n-gram slot has a log-count ratio: how much more often toxic documents
contain it than others. A logistic regression is fitted on the slots' presence times
that ratio, so evidence that naive Bayes finds weak stays weak. Ratios are counted on
Spark; the regression is fitted on the slots whose ratio is not negligible.

Training takes at most ``sample`` labelled documents. Scoring is one pass over all
texts in Arrow batches, without a shuffle.

Defined results: NULL text is the empty text; it is scored like any other. Labelled rows
without doc_id or label are ignored; a document labelled twice is toxic if any label
says so. With fewer than two classes of labels the score is the label's smoothed share.
Other columns stay; columns of the input with a name of a result column are replaced.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quizloom.llm.hashed import NGrams, fit_logistic, labelled_sample
from quizloom.llm.text import hide, with_fields

ORDERS = (3, 4, 5, 6)
BITS = 20
SAMPLE = 20_000
THRESHOLD = 0.7
# Slots with a smaller absolute log-count ratio, or in fewer training documents, carry
# no weight.
MIN_RATIO = 2.0
MIN_DOCUMENTS = 5
L2 = 1e-5


@dataclass
class ToxicityModel:
    orders: tuple[int, ...]
    weights: np.ndarray
    # Squared ratios, for the norm of a row.
    squares: np.ndarray
    intercept: float

    def score(self, slots: np.ndarray) -> float:
        norm = np.sqrt(max(float(self.squares[slots].sum()), 1e-12))
        margin = float(self.weights[slots].sum()) / norm + self.intercept
        return float(1 / (1 + np.exp(-min(max(margin, -500), 500))))


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that is never trained on."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _ngrams(orders, only=None) -> NGrams:
    return NGrams(orders, bits=BITS, lower=True, only=only)


def _slot_counts(orders):
    def count(batches):
        ngrams = _ngrams(orders)
        counts = np.zeros((2, 1 << BITS), dtype=np.int64)
        rows = [0, 0]
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("y").to_pylist()):
                rows[y] += 1
                counts[y, ngrams(text.as_py() or "")] += 1
        for y in (0, 1):
            slots = np.flatnonzero(counts[y])
            yield pa.RecordBatch.from_pydict(
                {
                    "y": pa.array([y] * (len(slots) + 1), pa.int32()),
                    "slot": pa.array(np.append(slots, -1), pa.int32()),
                    "n": pa.array(np.append(counts[y][slots], rows[y]), pa.int64()),
                }
            )

    return count


def _chosen_slots(orders, chosen: np.ndarray):
    def choose(batches):
        ngrams = _ngrams(orders, chosen)
        for batch in batches:
            kept = [ngrams(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {"y": batch.column("y"), "slots": pa.array(kept, pa.list_(pa.int32()))}
            )

    return choose


def train_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    orders: tuple[int, ...] = ORDERS,
    min_ratio: float = MIN_RATIO,
    min_documents: int = MIN_DOCUMENTS,
    l2: float = L2,
) -> ToxicityModel:
    """Fit on labelled documents outside the held-out third.

    The sample has at most ``sample`` ids, so it is broadcast and texts do not move.
    """
    usable = labels.filter(~held_out(F.col("doc_id")))
    chosen = labelled_sample(usable.select("doc_id", "toxic"), "toxic", sample)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("text", "y")
    counted = rows.mapInArrow(_slot_counts(orders), "y INT, slot INT, n BIGINT")
    clean, toxic = (F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)) for y in (0, 1))
    sums = counted.groupBy("slot").agg(clean.alias("clean"), toxic.alias("toxic"))
    common = (F.col("slot") < 0) | (F.col("clean") + F.col("toxic") >= min_documents)
    table = sums.filter(common).toPandas()
    totals = table[table["slot"] < 0][["clean", "toxic"]].sum()
    table = table[table["slot"] >= 0]
    # Shares of documents, smoothed by one document each.
    share = {y: (table[y].to_numpy() + 1) / (totals[y] + 2) for y in ("clean", "toxic")}
    ratio = np.zeros(1 << BITS)
    ratio[table["slot"].to_numpy()] = np.log(share["toxic"] / share["clean"])
    ratio[np.abs(ratio) < min_ratio] = 0
    slots = rows.mapInArrow(_chosen_slots(orders, ratio != 0), "y INT, slots ARRAY<INT>").toPandas()
    weights, intercept = fit_logistic(
        [np.asarray(s, dtype=np.int64) for s in slots["slots"]] or [np.empty(0, dtype=np.int64)],
        slots["y"].to_numpy() if len(slots) else np.zeros(0),
        ratio,
        l2,
    )
    return ToxicityModel(orders, weights * ratio, ratio**2, intercept)


def score_toxicity(
    documents: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD
) -> DataFrame:
    """``documents`` with ``held_out``, ``score`` in 0..1 and ``predicted`` 0 or 1."""
    base, show = hide(documents, "doc_id", "text")

    def score(batches):
        ngrams = _ngrams(model.orders, model.squares > 0)
        for batch in batches:
            scores = [model.score(ngrams(t.as_py() or "")) for t in batch.column("text")]
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["score"] = pa.array(scores, pa.float64())
            yield pa.RecordBatch.from_pydict(columns)

    scored = base.mapInArrow(score, with_fields(base.schema, {"score": "double"}))
    scored = scored.withColumn("held_out", held_out(F.col("doc_id"))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
    return show(scored, "held_out", "score", "predicted")
