"""Every registered query against its SQL twin, on whole tables."""

import compare
import pytest

import __spark_entry__ as entry_points
from broadsheet.catalog import lake_queries, oracle, queries, upkeep_queries

QUERIES = queries.REGISTRY | lake_queries.REGISTRY | upkeep_queries.REGISTRY
ORACLE = oracle.SQL | lake_queries.SQL | upkeep_queries.SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, con, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_without_sql_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 183
