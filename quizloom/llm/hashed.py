"""Hashed n-gram features and a logistic regression on bounded samples of labelled rows."""

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.text import WORD_RE

BITS = 18
# Texts are hashed in blocks, so that a very long one needs no more memory.
BLOCK_CHARS = 1 << 20
WORD_CACHE = 1 << 17
# Rows that a fit works on at a time.
FIT_ROWS = 512
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x100000001B3)


class NGrams:
    """Distinct feature slots of a text: character n-grams and, if asked, words.

    Words give unigrams and bigrams. Slots lie in 0..2^bits-1. With ``only``, a mask of
    slots, others are left out early.
    """

    def __init__(self, orders=(3, 4, 5), words=False, bits=BITS, lower=False, only=None):
        self.orders, self.words, self.bits = orders, words, bits
        self.lower, self.only = lower, only
        self._last = np.zeros(1 << bits, dtype=np.int32)
        self._word_hash: dict[str, int] = {}

    def _distinct(self, slots: np.ndarray) -> np.ndarray:
        """The slots without repeats, unordered: of equal ones only the last stays."""
        place = np.arange(len(slots), dtype=np.int32)
        self._last[slots] = place
        return slots[self._last[slots] == place]

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        slots = ((codes * _MIX) >> np.uint64(64 - self.bits)).astype(np.int32)
        return slots if self.only is None else slots[self.only[slots]]

    def _characters(self, block: str) -> list[np.ndarray]:
        codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = codes.astype(np.uint64) + np.uint64(1)
        rolling, found = codes, []
        for n in range(1, max(self.orders) + 1):
            if n > 1:
                if len(codes) < n:
                    break
                rolling = rolling[: len(codes) - n + 1] * _STEP
                rolling = rolling + codes[n - 1 :]
            if n in self.orders:
                found.append(self._slots(rolling ^ np.uint64(n << 56)))
        return found

    def _word_slots(self, text: str) -> list[np.ndarray]:
        known = self._word_hash
        if len(known) > WORD_CACHE:
            known.clear()
        words = WORD_RE.findall(text)
        for word in set(words):
            if word not in known:
                known[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) + 1
        codes = np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))
        pairs = codes[:-1] * _STEP + codes[1:]
        return [
            self._slots(codes ^ np.uint64(11 << 56)),
            self._slots(pairs ^ np.uint64(12 << 56)),
        ]

    def __call__(self, text: str) -> np.ndarray:
        if self.lower:
            text = text.lower()
        found = []
        overlap = max(self.orders) - 1
        for at in range(0, max(len(text), 1), BLOCK_CHARS):
            parts = self._characters(text[at : at + BLOCK_CHARS + overlap])
            if parts:
                found.append(self._distinct(np.concatenate(parts)))
        if self.words:
            found += [self._distinct(part) for part in self._word_slots(text)]
        if not found:
            return np.empty(0, dtype=np.int32)
        return found[0] if len(found) == 1 else self._distinct(np.concatenate(found))


def labelled_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``doc_id, y`` of at most ``rows`` labelled documents, chosen by a hash of doc_id.

    Rows without a doc_id or label are left out; a document labelled twice takes the
    larger label.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    once = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def fit_logistic(
    slots: list[np.ndarray],
    y: np.ndarray,
    scale: np.ndarray,
    l2: float,
    balance: bool = False,
    steps: int = 60,
) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-regularised logistic regression.

    Row i has the value ``scale[s] / row norm`` at each of its slots s. L-BFGS with a
    short memory; the work is a few passes over the sample's slots.
    """
    y = y.astype(np.float64)
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return np.zeros(len(scale)), float(np.log(rate / (1 - rate)))
    lengths = np.array([len(s) for s in slots])
    flat = np.concatenate(slots).astype(np.int32, copy=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    # Rows are worked on in blocks, so that only the slots themselves are held for all.
    blocks = [
        (lo, min(lo + FIT_ROWS, len(slots))) for lo in range(0, len(slots), FIT_ROWS)
    ]

    def row_sums(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(slots))
        for lo, hi in blocks:
            rows = np.repeat(np.arange(hi - lo), lengths[lo:hi])
            out[lo:hi] = np.bincount(rows, values[flat[starts[lo] : starts[hi]]], hi - lo)
        return out

    def slot_sums(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(scale))
        for lo, hi in blocks:
            repeated = np.repeat(values[lo:hi], lengths[lo:hi])
            out += np.bincount(flat[starts[lo] : starts[hi]], repeated, len(scale))
        return out

    norm = 1 / np.sqrt(np.maximum(row_sums(scale**2), 1e-12))
    share = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) if balance else np.ones(len(y))
    share = share / len(y)

    def loss(point):
        margin = norm * row_sums(scale * point[:-1]) + point[-1]
        sign = 2 * y - 1
        total = share @ np.logaddexp(0, -sign * margin) + l2 / 2 * point[:-1] @ point[:-1]
        slope = share * (1 / (1 + np.exp(-margin)) - y)
        inner = scale * slot_sums(norm * slope) + l2 * point[:-1]
        return total, np.append(inner, slope.sum())

    point = np.zeros(len(scale) + 1)
    total, slope = loss(point)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way = -slope
        seen = []
        for s, d in reversed(past):
            a = (s @ way) / (s @ d)
            seen.append(a)
            way = way - a * d
        if past:
            s, d = past[-1]
            way = way * ((s @ d) / (d @ d))
        for (s, d), a in zip(past, reversed(seen)):
            way = way + s * (a - (d @ way) / (s @ d))
        size = 1.0
        while size > 1e-6:
            trial = point + size * way
            new_total, new_slope = loss(trial)
            if new_total <= total + 1e-4 * size * (slope @ way):
                break
            size /= 2
        else:
            break
        s, d = trial - point, new_slope - slope
        if s @ d > 1e-12:
            past = [*past[-7:], (s, d)]
        done = total - new_total < 1e-7 * abs(total)
        point, total, slope = trial, new_total, new_slope
        if done:
            break
    return point[:-1], float(point[-1])
