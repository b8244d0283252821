"""Every registered query with checking SQL against the checking database, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import database, database_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def base():
    return database(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches(spark, base, name):
    names, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_names, _, expected = database_rows(base, ORACLES[name])
    assert names == expected_names
    assert rows == expected


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.count() > 0 and "segment_produit" in result.columns
