import hashlib

import pytest
from pyspark.sql import functions as F

from quizloom.operators.joins import lookup_join, salted_join
from quizloom.operators.numbering import dense_ids, row_positions, shuffled_positions


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_dense_ids(spark, parts):
    keys = sorted({(i * 7919) % 50_000 for i in range(3000)})
    df = spark.createDataFrame([(k, f"t{k}") for k in reversed(keys)], "k LONG, t STRING")
    found = dense_ids(df.repartition(parts), "k", "n", width=16).collect()
    assert sorted((r["n"], r["k"], r["t"]) for r in found) == [
        (i, k, f"t{k}") for i, k in enumerate(keys)
    ]


def test_sparse_ids_need_several_levels(spark):
    keys = sorted({(i * 2654435761987) % (1 << 62) for i in range(2000)} | {0, 1, (1 << 62) - 1})
    df = spark.createDataFrame([(k,) for k in keys], "k LONG")
    found = dense_ids(df.repartition(4), "k", "n").collect()
    assert sorted((r["n"], r["k"]) for r in found) == list(enumerate(keys))
    assert dense_ids(df.limit(0), "k", "n").count() == 0


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_shuffled_positions(spark, parts):
    df = spark.range(500).repartition(parts)
    found = shuffled_positions(df, "s", F.col("id"), digits=2).collect()
    ids = sorted(range(500), key=lambda i: (hashlib.md5(f"s:{i}".encode()).hexdigest(), i))
    assert sorted((r["position"], r["id"]) for r in found) == list(enumerate(ids))


def test_row_positions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(5).write.parquet(path)
    found = row_positions(spark.read.parquet(path), "n").collect()
    assert sorted(r["n"] for r in found) == list(range(1000))
    assert len({r["id"] for r in found}) == 1000


@pytest.mark.parametrize("join", ["salted", "broadcast", "lookup-salted"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_skewed_joins(spark, join, how):
    """A third of the rows share one key; some keys have no lookup row."""
    facts = spark.range(900).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k")
    )
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    expected = facts.join(lookup, "k", how)
    if join == "salted":
        found = salted_join(facts, lookup, "k", F.col("id"), how, hot_rows=20)
    else:
        limit = 10_000 if join == "broadcast" else 5
        found = lookup_join(facts, lookup, "k", F.col("id"), how, max_broadcast_bytes=limit)
    rows = lambda df: sorted(map(tuple, df.select("id", "k", "v").collect()), key=str)
    assert rows(found) == rows(expected)
