"""Importance resampling against a plain version."""

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quizloom.llm import resample
from helpers import edge_documents, empty_documents

WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, order):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]
    return [zlib.crc32(run.encode()) for run in runs], len(words)


def plain_version(rows, target, percent=10, order=1, buckets=10_000, min_words=20, seed=2024):
    source, wanted = Counter(), Counter()
    features = []
    for _, text in rows:
        crcs, n_words = plain_features(text, order)
        features.append(([c % buckets for c in crcs], n_words))
        source.update(features[-1][0])
    for text in target:
        wanted.update(c % buckets for c in plain_features(text, order)[0])
    all_s, all_t = sum(source.values()), sum(wanted.values())
    gains = {
        b: math.floor(1000 * math.log((wanted[b] + 1.0) * (all_s + buckets) / ((source[b] + 1.0) * (all_t + buckets))))
        for b in source
    }
    out = []
    for (doc_id, _), (found, n_words) in zip(rows, features):
        digits = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        noise = math.floor(-1000 * math.log(-math.log((int(digits[:8], 16) + 0.5) / 4294967296)))
        weight = sum(gains[b] for b in found)
        out.append([doc_id, len(found), weight, weight + noise, None, n_words])
    usable = [r for r in out if r[5] >= min_words]
    usable.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(usable[: percent * len(usable) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def rows_of(found):
    return sorted(
        ((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found.collect()), key=repr
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ09_ -\n éÉ😀日", max_size=80), st.integers(1, 4))
def test_features(text, order):
    crcs, n_words = resample.Features(order).crcs(text)
    expected, count = plain_features(text, order)
    assert n_words == count
    assert sorted(crcs.tolist()) == sorted(expected)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_features_across_blocks(order, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK_CHARS", 7)
    text = "One two three fourteen-fifteen a b c d e f g " * 9 + "x" * 40 + " end"
    features = resample.Features(order)
    assert sorted(features.crcs(text)[0].tolist()) == sorted(plain_features(text, order)[0])
    lowered = text.translate(LOWER)
    assert all(lowered[s:e] == w for block in features.words(text) for w, (s, e) in block)


def documents_and_target():
    def words(i, n):
        return " ".join(f"w{(i * 7 + j * j) % 61}" for j in range(n))

    rows = [(i * 3 % 400, words(i, 5 + i % 60)) for i in range(400)]
    return rows, [words(i, 50) for i in range(0, 40, 4)]


@pytest.mark.parametrize("order, buckets", [(1, 10_000), (2, 10_000), (1, 70_000)])
def test_against_plain_version(spark, order, buckets):
    rows, target = documents_and_target()
    found = resample.resample(
        spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5),
        spark.createDataFrame([(t,) for t in target], "text STRING"),
        order=order,
        buckets=buckets,
    )
    assert rows_of(found) == plain_version(rows, target, order=order, buckets=buckets)


def test_drawn_documents_are_like_the_target(spark):
    plain = [(i, " ".join(f"p{(i + j * j) % 97}" for j in range(40))) for i in range(900)]
    like = [(1000 + i, " ".join(f"q{(i + j * j) % 97}" for j in range(40))) for i in range(100)]
    documents = spark.createDataFrame(plain + like, "doc_id BIGINT, text STRING")
    target = spark.createDataFrame([(t,) for _, t in like[:50]], "text STRING")
    ranked = resample.resample(documents, target)
    drawn = resample.drawn_documents(documents, ranked)
    assert {r.doc_id for r in drawn.collect()} == {i for i, _ in like}


@pytest.mark.parametrize("extra", ["row", "rank", "n_words", "buckets", "id", "_path", "a.b"])
def test_edge_rows(spark, extra):
    documents = edge_documents(spark).withColumn(extra, F.lit("mine"))
    target = spark.createDataFrame([("the quick brown fox",), (None,), ("",)], "text STRING")
    found = resample.resample(documents, target, percent=100)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    own, expected = rows_of(found), plain_version(rows, ["the quick brown fox"], percent=100)
    assert own == expected


def test_copies_and_missing_ids_are_ranked_one_by_one(spark):
    text = "word " * 25
    rows = [(None, text)] * 30 + [(7, text)] * 30 + [(i, text + str(i)) for i in range(40)]
    documents = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = resample.resample(documents, spark.createDataFrame([("word",)], "text STRING"), percent=60)
    ranks = [r["rank"] for r in found.collect() if r["rank"] is not None]
    assert sorted(ranks) == list(range(1, 61))


def test_empty_tables(spark):
    empty = empty_documents(spark)
    some = spark.createDataFrame([(1, "one two")], "doc_id BIGINT, text STRING")
    assert resample.resample(empty, some).count() == 0
    assert rows_of(resample.resample(some, empty, min_words=1, percent=100))[0][4] == 1
