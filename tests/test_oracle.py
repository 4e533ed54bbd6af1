"""Every registered query against its SQL twin on the sample tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from clickloom.checks.registry import QUERIES as REGISTERED

SF_DIR = "/root/testdata/sf0.01"
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    # Only operators on training data may be beyond SQL; their tests hold them against brute force.
    assert set(ORACLES) <= set(QUERIES)
    assert set(REGISTERED) <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [item[0] for item in cursor.description]
    expected = cursor.fetchall()
    assert sorted(result.columns) == sorted(columns)
    assert _bag(result.columns, [tuple(row) for row in result.collect()]) == _bag(columns, expected)
    assert expected
