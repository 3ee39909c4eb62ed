"""Every registered query with an SQL equivalent, compared with DuckDB on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def text_rows(rows):
    return sorted(tuple(map(repr, r)) for r in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF_DIR)
    cols = sorted(got.columns)
    result = duck.execute(contract.oracle_sql()[name])
    named = [c[0] for c in result.description]
    assert sorted(named) == cols
    want = [tuple(r[named.index(c)] for c in cols) for r in result.fetchall()]
    assert want
    assert text_rows(tuple(r[c] for c in cols) for r in got.collect()) == text_rows(want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
