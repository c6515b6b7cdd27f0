"""Fill-in-middle against a plain version, and its boundary set against sorted lists."""

import re
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quizloom.llm import boundaries, fim
from helpers import edge_documents, empty_documents

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_version(doc_id, text, seed=fim.SEED):
    text = text or ""
    tokens = TOKEN.findall(text)
    digits = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = ("".join(tokens[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return n, form, len(pre), len(mid), out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c é😀<P>SM", max_size=60))
def test_token_ends(text):
    ends = fim.token_ends(text)
    expected = [m.end() for m in TOKEN.finditer(text)]
    assert [fim.cut_offset(ends, k) for k in range(len(ends) + 1)] == [0, *expected]


@pytest.mark.parametrize("shift", [-2, -1, 0, 1, 2])
def test_token_ends_at_container_bounds(shift):
    size = boundaries.CONTAINER + shift
    for text in ("x" * size, "x" * size + " ", " " * size + "y", "a " * (size // 2) + "b" * 70_000 + "  "):
        ends = fim.token_ends(text)
        expected = [m.end() for m in TOKEN.finditer(text)]
        assert len(ends) == len(expected)
        picks = {0, len(expected) // 2, len(expected) - 1}
        assert all(fim.cut_offset(ends, k + 1) == expected[k] for k in picks)


@pytest.mark.parametrize(
    "members, kind",
    [
        ([5, 9, 70], boundaries.ArrayContainer),
        (range(100, 40_000), boundaries.RunContainer),
        ([*range(0, 30), *range(400, 900), 65_535], boundaries.RunContainer),
        (range(0, 65_536, 2), boundaries.BitmapContainer),
        (range(63, 65_536, 5), boundaries.BitmapContainer),
        ([0], boundaries.ArrayContainer),
        ([65_535], boundaries.ArrayContainer),
    ],
)
def test_containers_select_every_member(members, kind):
    members = np.array(list(members))
    held = boundaries.container(members)
    assert isinstance(held, kind)
    assert [held.select(k) for k in range(len(members))] == members.tolist()


def test_set_of_several_containers():
    parts = {0: range(0, 9, 3), 2: range(0, 65_536, 2), 7: range(10, 5_000)}
    found = boundaries.BoundarySet()
    expected = []
    for key, members in parts.items():
        found.add(key, np.array(list(members)))
        expected += [key * boundaries.CONTAINER + m for m in members]
    found.add(9, np.empty(0, dtype=np.int64))
    assert len(found) == len(expected)
    for k in [0, 2, 3, 4, 1000, len(expected) - 1]:
        assert found.select(k) == expected[k]
    for k in (-1, len(expected)):
        with pytest.raises(IndexError):
            found.select(k)


def test_against_plain_version(spark):
    rows = [(i, f"word{i}  and {'x ' * (i % 7)}\n more é😀 text {i}\t") for i in range(300)]
    rows += [(1000 + i, t) for i, t in enumerate(["", " ", "\n\n", "a", " a", "<P> here", "a <M", "<S"] * 8)]
    found = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    back = found.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert {r.form for r in back} == {"plain", "psm", "spm"}
    for r in back:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_version(r.doc_id, r.text)
        assert r.back == r.text


@pytest.mark.parametrize("extra", ["cuts", "cuts_", "range", "a.b", "N", "form", "output", "n"])
def test_edge_rows(spark, extra):
    documents = edge_documents(spark).withColumn(extra, F.lit("mine"))
    found = fim.fill_in_middle(documents)
    rows = found.collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_version(
            r["doc_id"], r["text"]
        )
    if extra.lower() not in fim.RESULTS:
        assert {r[extra] for r in rows} == {"mine"}


def test_empty_table(spark):
    assert fim.fill_in_middle(empty_documents(spark)).count() == 0


def test_shares_of_forms(spark):
    documents = spark.range(4000).selectExpr("id AS doc_id", "concat('text of ', id) AS text")
    counts = dict(fim.fill_in_middle(documents, fim_percent=30, spm_percent=10).groupBy("form").count().collect())
    assert abs(counts["plain"] - 2800) < 120
    assert abs(counts["spm"] - 120) < 40
