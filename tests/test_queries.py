"""Every registered query against its SQL on the smallest driver tables."""

import os
import sys

import pytest

duckdb = pytest.importorskip("duckdb")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
if not os.path.isdir(SF_DIR):
    pytest.skip("no driver tables", allow_module_level=True)

from quizloom.checks.oracle import ORACLE  # noqa: E402
from quizloom.checks.registry import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(found.columns)
    expected = sorted_rows(columns, result.fetchall())
    assert expected
    assert sorted_rows(found.columns, found.collect()) == expected
