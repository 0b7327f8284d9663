"""Every registered query of the analytics part against its DuckDB statement, at sf0.001."""

import os

import pytest

import __spark_entry__ as entry
import oracle_queries
from pulse.plans import registry
from tests.oracle_harness import compare, duck_connection

SF = os.environ.get("PULSE_TEST_SF", "/root/testdata/sf0.001")
ORACLE = oracle_queries.oracle_sql()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, n, _, detail = compare(spark, name, QUERIES[name], ORACLE[name], SF, con)
    assert ok, detail


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 200
    assert df.columns[:3] == ["movie_id", "title", "release_date"]
