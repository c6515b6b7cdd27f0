"""Quality rules: fixed counts first, then a calibrated n-gram classifier.

A document fails at once if it has fewer than 50 words or if more than half of its words
repeat. All others are judged by a logistic regression on hashed word and character
n-grams, trained on labelled quality rows and calibrated on a part of them that was not
used for the fit; documents whose probability of being good is below a fixed threshold
go. Documents are scored in Arrow batches, without a shuffle.

Training takes at most ``sample`` labelled documents that pass the fixed counts.

Defined results: NULL text has no words and fails. Labelled rows without doc_id or label
are ignored; a document labelled twice takes the better label. With fewer than two
classes of labels the probability is the label's smoothed share. Other columns stay;
columns of the input with a name of a result column are replaced.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.hashed import BITS, NGrams, fit_logistic, labelled_sample
from quizloom.llm.tasks import releasing
from quizloom.llm.text import SPACES, WORD_RE, hide, with_fields

# Limits of the base rules and the characters that count as symbols.
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
WINDOW = 3

ORDERS = (2, 3, 4)
SAMPLE = 4_000
# Documents with a smaller probability of being good go. The label sets the odds; a low
# threshold leaves the doubtful ones in.
THRESHOLD = 0.3
L2 = 1e-5


@dataclass
class QualityModel:
    weights: np.ndarray
    intercept: float
    # Calibration: probability = logistic(slope * margin + shift).
    slope: float
    shift: float

    def margin(self, slots: np.ndarray) -> float:
        return float(self.weights[slots].sum()) / np.sqrt(max(len(slots), 1)) + self.intercept

    def probability(self, slots: np.ndarray) -> float:
        x = self.slope * self.margin(slots) + self.shift
        return float(1 / (1 + np.exp(-min(max(x, -500), 500))))


def new_ngrams() -> NGrams:
    return NGrams(ORDERS, words=True)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = WORD_RE.findall(text)
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    seen, n_dup_lines = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n_dup_lines += bool(line.strip(SPACES))
        else:
            seen.add(line)
    return len(words), sum(map(len, words)), n_symbols, n_dup_lines, _repeated(words)


def _repeated(words: list[str]) -> int:
    """Words covered by a window of three that the text has at least twice."""
    if len(words) <= WINDOW:
        return 0
    number: dict[str, int] = {}
    codes = np.fromiter(
        (number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words)
    )
    # Pairs are renumbered before the third word is added, so no product overflows.
    _, pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)
    _, where, times = np.unique(
        pairs[:-1] * len(number) + codes[2:], return_inverse=True, return_counts=True
    )
    starts = np.flatnonzero(times[where] >= 2)
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(WINDOW):
        covered[starts + shift] = True
    return int(covered.sum())


def fails_base(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > 50 * n_words


def _training_slots(batches):
    ngrams = new_ngrams()
    for batch in batches:
        rows = []
        for text, y in zip(batch.column("text"), batch.column("y").to_pylist()):
            text = text.as_py() or ""
            counts = base_counts(text)
            if not fails_base(counts[0], counts[4]):
                # Part 0 calibrates, the others fit.
                part = zlib.crc32(text.encode("utf-8", "surrogatepass")) % 5
                rows.append((y, part, ngrams(text)))
        yield pa.RecordBatch.from_pydict(
            {
                "y": pa.array([r[0] for r in rows], pa.int32()),
                "part": pa.array([r[1] for r in rows], pa.int32()),
                "slots": pa.array([r[2] for r in rows], pa.list_(pa.int32())),
            }
        )


def train_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fit and calibrate. The sample has at most ``sample`` ids and is broadcast."""
    chosen = labelled_sample(labels.select("doc_id", "quality"), "quality", sample)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    schema = "y INT, part INT, slots ARRAY<INT>"
    table = rows.select("text", "y").mapInArrow(releasing(_training_slots), schema).toArrow()
    y, fit = table["y"].to_numpy(), table["part"].to_numpy() != 0
    # Views of the table's own memory; the sample is held once.
    slots = [s.values.to_numpy() for chunk in table["slots"].chunks for s in chunk]
    slots = slots or [np.empty(0, np.int32)]
    ones = np.ones(1 << BITS)
    weights, intercept = fit_logistic([s for s, f in zip(slots, fit) if f] or slots, y[fit], ones, L2)
    model = QualityModel(weights, intercept, 1.0, 0.0)
    if len(y[~fit]):
        margins = np.array([model.margin(s) for s, f in zip(slots, fit) if not f])
        model.slope, model.shift = calibrate(margins, y[~fit])
    return model


def calibrate(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of Platt scaling, with his smoothed targets; Newton's method."""
    good, bad = (y > 0).sum(), (y <= 0).sum()
    if not good or not bad:
        return 1.0, 0.0
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    point = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ point, -500, 500)))
        slope = x.T @ (p - target) + 1e-6 * point
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        point = point - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(point[0]), float(point[1])


RESULT = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "base_failed": "boolean",
    "probability": "double",
    "kept": "boolean",
}
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}


def judge_quality(
    documents: DataFrame, model: QualityModel, threshold: float = THRESHOLD
) -> DataFrame:
    """``documents`` with base counts, verdicts and the probability of being good.

    Documents that fail the base rules have no probability.
    """
    base, show = hide(documents, "text")

    def judge(batches):
        ngrams = new_ngrams()
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                counts = base_counts(text)
                failed = fails_base(counts[0], counts[4])
                p = None if failed else model.probability(ngrams(text))
                rows.append((*counts, failed, p, not failed and p >= threshold))
            columns = {name: batch.column(name) for name in batch.schema.names}
            for i, (name, kind) in enumerate(RESULT.items()):
                columns[name] = pa.array([r[i] for r in rows], _ARROW[kind])
            yield pa.RecordBatch.from_pydict(columns)

    return show(base.mapInArrow(releasing(judge), with_fields(base.schema, RESULT)), *RESULT)
