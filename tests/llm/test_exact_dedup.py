import hashlib
import re
from collections import defaultdict

from helpers import edge_documents, empty_documents
from pyspark.sql import functions as F

from quizloom.llm.bits import may_be_among
from quizloom.llm.exact_dedup import build_index, exact_dedup, grow_directory, mark_copies

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(rows):
    groups = defaultdict(list)
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    for (doc_id, _), norm in zip(rows, normal):
        groups[norm].append(doc_id)
    out = []
    for (doc_id, _), norm in zip(rows, normal):
        ids = [i for i in groups[norm] if i is not None]
        keep = min(ids) if ids else None
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out.append((doc_id, keep, len(groups[norm]), doc_id == keep, digest))
    return sorted(out, key=repr)


def test_edge_rows(spark):
    docs = edge_documents(spark, "kept")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    marked = mark_copies(docs, build_index(docs))
    assert sorted((tuple(r) for r in marked.select(*COLUMNS).collect()), key=repr) == brute(rows)
    empty = empty_documents(spark)
    assert mark_copies(empty, build_index(empty)).count() == 0
    assert set(exact_dedup(docs).columns) == set(docs.columns)


def test_small_buckets_split(spark):
    rows = [(i, f"text {i % 40}  {'y' * (i % 3)}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    index = build_index(docs, capacity=4)
    assert index.depth > 2
    sizes = index.records.groupBy("bucket", "bits").count()
    assert sizes.agg(F.max("count")).first()[0] <= 4
    marked = mark_copies(docs, index)
    assert sorted((tuple(r) for r in marked.select(*COLUMNS).collect()), key=repr) == brute(rows)


def test_colliding_hashes_are_chained(spark):
    """With very few hash values, or one, only the bytes tell texts apart."""
    rows = [(i, f"text {i % 30}" if i % 3 else "hot  text") for i in range(300)] + [(None, "text 1")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    for hash_of in (lambda c: F.lit(7).cast("bigint"), lambda c: F.xxhash64(c) % 3):
        index = build_index(docs, hash_of=hash_of)
        assert index.records.agg(F.max("link")).first()[0] > 1
        assert index.records.count() == len({t for _, t in rows})
        marked = mark_copies(docs, index)
        assert sorted((tuple(r) for r in marked.select(*COLUMNS).collect()), key=repr) == brute(rows)


def test_only_texts_of_repeated_hashes_move(spark):
    rows = [(i, f"only text {i}") for i in range(500)] + [(i, "copy") for i in range(500, 520)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    hashed = docs.select("doc_id", F.xxhash64("text").alias("h"))
    repeated = hashed.groupBy("h").count().filter("count > 1")
    assert 20 <= may_be_among(hashed, repeated).count() < 25
    index = build_index(docs)
    assert index.records.count() == 501
    assert index.records.filter("text_sha256 IS NOT NULL").count() == 1


def test_directory_points_every_slot(spark):
    """Skewed hashes deepen one side; the bound on bits ends the doubling."""
    hashes = spark.range(64).selectExpr("id AS h").union(spark.range(4).selectExpr("shiftleft(id, 62) AS h"))
    directory, depth = grow_directory(hashes, capacity=8, max_depth=6)
    assert depth == 6
    slots = [r.slot for r in directory.select("slot").collect()]
    assert len(slots) == len(set(slots))
    assert {0, 16, 32, 48} <= set(slots)
