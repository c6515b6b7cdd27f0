import math
import random
import zlib
from collections import Counter

import numpy as np
from helpers import edge_documents, empty_documents

from quizloom.llm.hashed import NGrams, fit_logistic
from quizloom.llm.quality import base_counts, calibrate, fails_base, judge_quality, train_quality
from quizloom.llm.text import WORD_RE
from quizloom.llm.toxicity import score_toxicity, train_toxicity

VOWELS, CONSONANTS = "aeiou", "bdfglmnprst"


def words(r, n):
    return [r.choice(CONSONANTS) + r.choice(VOWELS) + r.choice(CONSONANTS) + r.choice(VOWELS) for _ in range(n)]


def labelled(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, y, y) for i, _, y in rows], "doc_id BIGINT, toxic INT, quality INT")
    return docs, labels


def test_toxicity_held_out(spark):
    r = random.Random(5)
    rows = []
    for i in range(900):
        text, toxic = words(r, 60), int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                text.insert(r.randrange(60), r.choice(["vexoil", "krumpaz", "zwogge"]) + r.choice(["", "en", "s"]))
        rows.append((i, " ".join(text), toxic))
    docs, labels = labelled(spark, rows)
    labels = labels.union(spark.createDataFrame([(None, 1, 1), (5, None, None)], labels.schema))
    result = {row.doc_id: row for row in score_toxicity(docs, train_toxicity(docs, labels)).collect()}
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i in result if result[i].held_out} == set(held)
    right = sum(result[i].predicted == rows[i][2] for i in held)
    assert right >= 0.98 * len(held)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.7) for row in result.values())


def test_toxicity_ignores_held_out_labels(spark):
    r = random.Random(6)
    rows = [(i, " ".join(words(r, 40)), i % 2) for i in range(120)]
    docs, labels = labelled(spark, rows)
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) AS toxic"
    )
    scores = [
        sorted((r.doc_id, r.score) for r in score_toxicity(docs, train_toxicity(docs, which)).collect())
        for which in (labels, flipped)
    ]
    assert scores[0] == scores[1]


def test_edge_rows(spark):
    docs = edge_documents(spark, "score")
    _, none = labelled(spark, [])
    _, one = labelled(spark, [(1, "", 1), (2, "", 1)])
    for labels in (none, one):
        scored = score_toxicity(docs, train_toxicity(docs, labels))
        assert scored.count() == docs.count()
        judged = judge_quality(docs, train_quality(docs, labels))
        assert judged.count() == docs.count()
        assert {"lang", "source", "score"} <= set(judged.columns)
    empty = empty_documents(spark)
    assert score_toxicity(empty, train_toxicity(empty, none)).count() == 0
    assert judge_quality(empty, train_quality(empty, none)).count() == 0


def brute_counts(text):
    found = WORD_RE.findall(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, line in enumerate(lines) if WORD_RE.search(line) and line in lines[:i])
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_base_counts():
    r = random.Random(7)
    for _ in range(200):
        text = "".join(r.choice(["a", "b", "c ", " ", "\n", "# ", "é|", "\x0b", " "]) for _ in range(r.randrange(80)))
        assert base_counts(text) == brute_counts(text)
    assert base_counts("") == (0, 0, 0, 0, 0)
    assert fails_base(49, 0) and not fails_base(50, 25) and fails_base(50, 26)


def test_quality_verdicts(spark):
    r = random.Random(8)
    rows = []
    for i in range(600):
        text, good = words(r, 80), int(i % 4 > 0)
        if not good:
            text = [w + r.choice(["###", "$$$", " |"]) for w in text]
        rows.append((i, " ".join(text), good))
    docs, labels = labelled(spark, rows)
    # A third of the labels is not seen in training.
    model = train_quality(docs, labels.filter("doc_id % 3 > 0"))
    judged = {row.doc_id: row for row in judge_quality(docs, model).collect()}
    for i, text, good in rows:
        row = judged[i]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == brute_counts(text)
        assert row.base_failed == fails_base(row.n_words, row.n_repeat_words)
        assert row.kept == (not row.base_failed and bool(good))


def plain_slots(text, orders, bits, words=False):
    """Slots by whole numbers, one n-gram at a time."""
    found, top = set(), 1 << 64
    step, mix = 0x100000001B3, 0x9E3779B97F4A7C15

    def add(code, kind):
        found.add(((code ^ (kind << 56)) * mix % top) >> (64 - bits))

    for n in orders:
        for at in range(len(text) - n + 1):
            code = 0
            for c in text[at : at + n]:
                code = (code * step + ord(c) + 1) % top
            add(code, n)
    if words:
        codes = [zlib.crc32(w.encode()) + 1 for w in WORD_RE.findall(text)]
        for code in codes:
            add(code, 11)
        for a, b in zip(codes, codes[1:]):
            add((a * step + b) % top, 12)
    return found


def logistic(x):
    return 1 / (1 + math.exp(-x))


def mixed_rows(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        text, y = words(r, r.randrange(45, 75)), r.randrange(2)
        if y or r.random() < 0.3:
            text.insert(r.randrange(40), r.choice(["Vexoil", "krumpaz", "ZWOGGE", "naïf ☃ 😀"]))
        rows.append((i, " ".join(text), y))
    return [*rows, (n, "", 0), (n + 1, None, 0), (n + 2, "É" * 70, 1)]


def test_toxicity_scores_by_brute_force(spark):
    rows = mixed_rows(9, 150)
    docs, labels = labelled(spark, rows)
    model = train_toxicity(docs, labels, min_documents=2, min_ratio=0.5)
    slots = {i: plain_slots((t or "").lower(), (3, 4, 5, 6), 20) for i, t, _ in rows}
    used = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    totals = Counter(y for _, y in used)
    counts = Counter((s, y) for i, y in used for s in slots[i])
    ratio = {}
    for s in {s for s, _ in counts}:
        if counts[s, 0] + counts[s, 1] >= 2:
            toxic, clean = ((counts[s, y] + 1) / (totals[y] + 2) for y in (1, 0))
            if abs(math.log(toxic / clean)) >= 0.5:
                ratio[s] = math.log(toxic / clean)
    assert set(np.flatnonzero(model.squares).tolist()) == set(ratio)
    assert all(abs(model.squares[s] - v * v) < 1e-9 for s, v in ratio.items())
    for row in score_toxicity(docs, model).collect():
        own = [s for s in slots[row.doc_id] if s in ratio]
        norm = math.sqrt(max(sum(ratio[s] ** 2 for s in own), 1e-12))
        score = logistic(sum(model.weights[s] for s in own) / norm + model.intercept)
        assert abs(row.score - score) < 1e-9
        assert row.predicted == (row.score >= 0.7)


def test_quality_scores_by_brute_force(spark):
    rows = mixed_rows(10, 150)
    docs, labels = labelled(spark, rows)
    model = train_quality(docs, labels)
    kept = 0
    for row in judge_quality(docs, model).collect():
        text = row.text or ""
        counts = brute_counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert row.base_failed == failed
        if failed:
            assert row.probability is None and not row.kept
            continue
        own = plain_slots(text, (2, 3, 4), 18, words=True)
        margin = sum(model.weights[s] for s in own) / math.sqrt(len(own)) + model.intercept
        assert abs(row.probability - logistic(model.slope * margin + model.shift)) < 1e-9
        assert row.kept == (row.probability >= 0.3)
        kept += row.kept
    assert 0 < kept < len(rows)


def test_features_of_blocks_and_fit(monkeypatch):
    text = "some text that is cut into blocks " * 20
    whole = set(NGrams((2, 3), words=True)(text).tolist())
    monkeypatch.setattr("quizloom.llm.hashed.BLOCK_CHARS", 17)
    assert set(NGrams((2, 3), words=True)(text).tolist()) == whole
    slots = [np.array([0, 2]), np.array([1, 2])] * 20
    weights, intercept = fit_logistic(slots, np.array([1, 0] * 20), np.ones(4), 1e-3)
    assert weights[0] > 1 and weights[1] < -1 and abs(weights[2]) < 0.1 and weights[3] == 0
    slope, shift = calibrate(np.array([-2.0, -1, 1, 2] * 10), np.array([0, 0, 1, 1] * 10))
    assert slope > 0 and abs(shift) < 1
