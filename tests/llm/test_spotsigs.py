"""SpotSigs fingerprints against a plain version, and neighbours against a sorted list."""

import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quizloom.llm import spotsigs
from helpers import SENTENCE, edge_documents, empty_documents

ANCHORS = frozenset(spotsigs.ANCHORS)


def plain_chains(text, chain=spotsigs.CHAIN, gap=spotsigs.GAP):
    """The distinct (spot, next content words) tuples of a text."""
    words = [w for w in re.findall(r"[^\W_]+", text)]
    words = [w.lower() for w in words]
    found, last = set(), None
    for i, word in enumerate(words):
        if word in ANCHORS or last is None or i - last > gap:
            after = words[i + 1 :]
            follow = [w for w in after if w not in ANCHORS][:chain]
            found.add((word, *follow))
        if word in ANCHORS:
            last = i
    return found


def plain_jaccard(a, b):
    return len(a & b) / len(a | b)


words = st.sampled_from("the of and red green blue house tree river Stone de la x1 ÉTÉ été 日本".split())


@settings(max_examples=150, deadline=None)
@given(st.lists(words, max_size=60), st.lists(words, max_size=60))
def test_signatures_stand_for_chains(left, right):
    signer = spotsigs.SpotSignatures()
    a, b = " ".join(left), ", ".join(right)
    one, two = plain_chains(a), plain_chains(b)
    if not one or not two:
        return
    assert len(signer(a)) == len(one)
    common = len(np.intersect1d(signer(a), signer(b)))
    assert common == len(one & two)


def test_gap_makes_spots_of_plain_words():
    words = [f"word{i}" for i in range(100)]
    signer = spotsigs.SpotSignatures()
    assert len(signer(" ".join(words))) == 100
    text = "the " + " ".join(words)
    assert len(signer(text)) == len(plain_chains(text)) == 1 + 100 - spotsigs.GAP


def test_blocks_do_not_change_signatures(monkeypatch):
    text = f"{SENTENCE}, and again: {SENTENCE}! " * 5 + "the end of é"
    whole = spotsigs.SpotSignatures()(text)
    for size in (1, 3, 10, 64):
        monkeypatch.setattr(spotsigs, "_BLOCK_CHARS", size)
        assert np.array_equal(spotsigs.SpotSignatures()(text), whole)


def test_texts_without_words():
    signer = spotsigs.SpotSignatures()
    found = [spotsigs.encode(signer(t)) for t in ("", " ", "--", "!!", "--")]
    assert found[2] == found[4]
    assert len(set(found)) == 4


@settings(max_examples=200, deadline=None)
@given(
    st.sets(st.integers(0, 400), min_size=1),
    st.sets(st.integers(0, 400), min_size=1),
    st.sampled_from([0.05, 0.1, 0.5, 0.8]),
)
def test_jaccard(a, b, least):
    found = spotsigs.jaccard(
        np.array(sorted(a), np.uint32), np.array(sorted(b), np.uint32), least
    )
    exact = plain_jaccard(a, b)
    assert found == (exact if exact >= least else 0.0)


def test_jaccard_leaves_early_and_stays_exact(monkeypatch):
    monkeypatch.setattr(spotsigs, "_COMPARED_AT_ONCE", 4)
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint32)
        b = np.unique(rng.integers(0, 60, rng.integers(1, 50))).astype(np.uint32)
        exact = plain_jaccard(set(a.tolist()), set(b.tolist()))
        assert spotsigs.jaccard(a, b, 0.3) == (exact if exact >= 0.3 else 0.0)


@pytest.mark.parametrize("least", [0.1, 0.5, 0.8])
def test_length_partitions_never_part_sets_that_could_match(least):
    for small in range(1, 300):
        for large in range(small, 300):
            apart = spotsigs.length_partition(large, least) - spotsigs.length_partition(small, least)
            assert apart <= 1 or small / large < least


def test_encoding_round_trip():
    signatures = np.array([0, 1, 77, 2**32 - 1], np.uint32)
    assert np.array_equal(spotsigs.decode(spotsigs.encode(signatures)), signatures)


def expected_rows(rows):
    """``rows`` in the order in which they follow one another."""
    signer = spotsigs.SpotSignatures()
    out = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        edited = spotsigs.edit(text, following)
        sets = [set(signer(t).tolist()) for t in (text, edited, following)]
        near = [plain_jaccard(sets[0], other) for other in sets[1:]]
        out.append(
            (
                doc_id,
                len(text),
                sha256(edited.encode()).hexdigest(),
                spotsigs.encode(signer(text)),
                spotsigs.encode(signer(edited)),
                *[n if n >= spotsigs.MIN_LIKENESS else 0.0 for n in near],
            )
        )
    return sorted(out, key=repr)


def found_rows(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


def test_edit():
    assert spotsigs.edit("abcdefgh", "xyz") == "abcdefxy"
    assert spotsigs.edit("abcdefghi", "x") == "abcdefx"
    assert spotsigs.edit("ab", "xyz") == "ab"
    assert spotsigs.edit("", "xyz") == ""


@pytest.mark.parametrize("range_rows", [1, 7, 50_000])
def test_neighbours_across_ranges(spark, monkeypatch, range_rows):
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", range_rows)
    rows = [
        (i * i % 1009, f"{SENTENCE} of the house {i % 5} and the tree {i} " * (1 + i % 9))
        for i in range(60)
    ]
    rows = [(-500 + i, t) for i, t in dict(rows).items()]
    documents = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(6)
    found = spotsigs.compare_neighbours(documents)
    assert found_rows(found) == expected_rows(sorted(rows, reverse=True))


@pytest.mark.parametrize("hot_rows", [3, 1_000])
@pytest.mark.parametrize("range_rows", [1, 50_000])
def test_rows_repeated_very_often(spark, monkeypatch, hot_rows, range_rows):
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", range_rows)
    rows = [(9, "the first of all")] + [(5, SENTENCE)] * 40 + [(2, "a last one of the house")]
    documents = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    found = spotsigs.compare_neighbours(documents, hot_rows=hot_rows)
    assert found_rows(found) == expected_rows(rows)


def test_edge_rows(spark):
    documents = edge_documents(spark).withColumn("range", F.lit(1)).withColumn("ahead", F.lit(1))
    documents = documents.withColumn("key", F.lit(1)).withColumn("copies", F.lit(1))
    found = spotsigs.compare_neighbours(documents).collect()
    texts = {(r.doc_id, r.text or "") for r in documents.collect()}
    assert len(found) == documents.count()
    signer = spotsigs.SpotSignatures()
    prints = {(d, len(t), spotsigs.encode(signer(t))) for d, t in texts}
    assert {(r.doc_id, r.n_chars, r.fingerprint) for r in found} == prints
    # Of two copies one is followed by the other.
    assert 1.0 in [r.near_next for r in found if r.doc_id == 2]


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(4, SENTENCE)], "doc_id BIGINT, text STRING")
    assert found_rows(spotsigs.compare_neighbours(one)) == expected_rows([(4, SENTENCE)])
    assert spotsigs.compare_neighbours(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("extra", ["range", "a.b", "fingerprint"])
def test_fingerprint_keeps_other_columns(spark, extra):
    documents = edge_documents(spark).withColumn(extra, F.lit("mine"))
    found = spotsigs.fingerprint(documents).collect()
    signer = spotsigs.SpotSignatures()
    assert len(found) == documents.count()
    assert all(r["fingerprint"] == spotsigs.encode(signer(r["text"] or "")) for r in found)
    if extra != "fingerprint":
        assert {r[extra] for r in found} == {"mine"}
