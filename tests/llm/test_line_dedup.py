import hashlib
from collections import defaultdict

import pytest
from helpers import edge_documents, empty_documents

from quizloom.llm.line_dedup import LineRuns, line_dedup
from quizloom.llm.text import SPACES


def brute(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))

    last = (1 << 63) - 1
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(last if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        own = last if doc_id is None else doc_id
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if len(key(line)) < 10 or min(holders[key(line)]) == own
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc_id, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=repr)


def found(df):
    columns = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (7, 3)])
def test_against_brute_force(spark, batches, fanout):
    rows = []
    for i in range(60):
        lines = [f"Common line number {i % 7}", f"  COMMON line number {i % 5}\t", f"own line of {i}", "short"]
        rows.append((i * 3 % 61, "\n".join(lines[i % 3 :] + lines[: i % 2])))
    rows += [(200, "Hot line for everyone\nx"), (200, "Hot line for everyone")]
    rows += [(300 + i, "Hot line for everyone") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert found(line_dedup(df, batches=batches, fanout=fanout)) == brute(rows)


def test_edge_rows(spark):
    docs = edge_documents(spark, "n_lines")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    result = line_dedup(docs)
    assert found(result) == brute(rows)
    assert {"lang", "source", "n_chars", "text"} <= set(result.columns)
    assert line_dedup(empty_documents(spark)).count() == 0


def test_runs_are_compacted(spark):
    runs = LineRuns(spark, fanout=2)
    for batch in range(4):
        lines = spark.range(100 * batch, 100 * batch + 100).selectExpr(
            "id", "unhex(md5(cast(id % 150 as string))) AS h"
        )
        runs.merge(lines)
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert runs.runs()[0].count() == 150
