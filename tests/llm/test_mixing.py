import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from helpers import edge_documents, empty_documents

from quizloom.llm.mixing import LEVELS, leaf_budgets, mix
from quizloom.llm.text import WORD_RE


def brute_budgets(leaves, budget, weights, max_epochs):
    """leaves: {path: tokens}. Water rises in steps until nobody can take more."""

    def cap(path):
        return sum(t * max_epochs for p, t in leaves.items() if p[: len(path)] == path)

    result = {(): min(budget, cap(()))}
    for depth, level in enumerate(LEVELS):
        for family in {p[:depth] for p in leaves}:
            children = sorted({p[: depth + 1] for p in leaves if p[:depth] == family}, key=repr)
            w = {c: weights.get(level, {}).get(c[-1], 1) for c in children}
            full, left = set(), Fraction(result[family])
            while True:
                open_ones = [c for c in children if c not in full]
                total = sum(w[c] for c in open_ones)
                now = {c for c in open_ones if cap(c) <= Fraction(w[c], total) * left}
                if not now:
                    break
                full |= now
                left -= sum(cap(c) for c in now)
            for c in children:
                result[c] = cap(c) if c in full else int(Fraction(w[c], total) * left)
    return {p: result[p] for p in leaves}


LEAVES = {
    ("a", "en", "s1"): 100, ("a", "en", "s2"): 10, ("a", "de", "s3"): 5, ("b", "en", "s4"): 1000,
    ("b", None, "s5"): 70, (None, "fr", None): 3, ("c", "en", "s6"): 0,
}
WEIGHTS = {"domain": {"a": 6, "b": 2, "c": 5}, "lang": {"en": 3}, "source": {"s2": 7}}


@pytest.mark.parametrize("budget", [0, 1, 50, 240, 500, 1500, 10**6])
def test_budgets(spark, budget):
    df = spark.createDataFrame(
        [(*p, t, 1) for p, t in LEAVES.items()], "domain STRING, lang STRING, source STRING, tokens BIGINT, docs BIGINT"
    )
    found = leaf_budgets(df, budget, WEIGHTS, max_epochs=2).collect()
    assert {(r.domain, r.lang, r.source): r.budget for r in found} == brute_budgets(LEAVES, budget, WEIGHTS, 2)


def brute_mix(rows, budget, weights, max_epochs, seed):
    leaves, members = defaultdict(int), defaultdict(list)
    for doc_id, text, domain, lang, source in rows:
        n = len(WORD_RE.findall(text or ""))
        row = hashlib.md5(f"{'-' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
        leaves[domain, lang, source] += n
        members[domain, lang, source].append((row, n, doc_id))
    out = []
    for path, given in brute_budgets(leaves, budget, weights, max_epochs).items():
        whole, part = divmod(given, leaves[path]) if leaves[path] else (0, 0)
        out += [(d, *path, e) for _, _, d in members[path] for e in range(whole)]
        sums = defaultdict(int)
        for row, n, _ in members[path]:
            sums[hashlib.md5(f"{seed}:{whole}:{row}".encode()).hexdigest()] += n
        upto, inside = 0, set()
        for order in sorted(sums):
            upto += sums[order]
            if part > 0 and upto <= part:
                inside.add(order)
        for row, _, d in members[path]:
            if hashlib.md5(f"{seed}:{whole}:{row}".encode()).hexdigest() in inside:
                out.append((d, *path, whole))
    return sorted(out, key=repr)


@pytest.mark.parametrize("budget,range_rows", [(40, 4096), (1000, 3), (3000, 2), (9000, 1)])
def test_selection(spark, budget, range_rows):
    rows = []
    for i in range(300):
        source = "src0" if i % 3 == 0 else f"src{i % 11}"
        rows.append((i, "w " * (i % 17), ["en", "de", None][i % 3], source, i))
    rows += [(7, "same row", "en", "src3", 1)] * 4 + [(None, "no id", "en", "src3", 1), (500, None, "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, epoch BIGINT")
    weights = {"domain": {"domain0": 5, "domain1": 2}, "lang": {"en": 2}, "source": {}}
    found = mix(docs, budget=budget, weights=weights, max_epochs=3, seed=9, range_rows=range_rows)
    got = sorted((tuple(r) for r in found.select("doc_id", *LEVELS, "epoch").collect()), key=repr)

    def domain(source):
        tail = source.removeprefix("src") if source else ""
        return f"domain{int(tail) % 4}" if tail else None

    plain = [(d, t, domain(s), lang, s) for d, t, lang, s, _ in rows]
    assert got == brute_mix(plain, budget, weights, 3, 9)


def test_edge_rows(spark):
    docs = edge_documents(spark, "epoch")
    found = mix(docs, budget_share=2.0)
    times = Counter((r.doc_id, r.text) for r in found.collect())
    given = Counter((r.doc_id, r.text) for r in docs.collect())
    for (doc_id, text), n in given.items():
        if WORD_RE.search(text or ""):
            assert times[doc_id, text] == 2 * n
    assert mix(empty_documents(spark)).count() == 0
    with pytest.raises(ValueError):
        mix(docs, weights={"domain": {"domain0": 0}})
