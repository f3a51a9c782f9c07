"""Every registered query against its DuckDB oracle, as multisets of rows."""

import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from brindle.plans import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, date) and not isinstance(value, datetime):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    rows = result.collect()
    assert name in ORACLES, f"{name} has no oracle"
    expected = duck.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert rows, "a query without rows checks nothing"
    got, want = _rows(result.columns, rows), _rows(columns, expected.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
