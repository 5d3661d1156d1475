"""Every registered query against its SQL restatement, and row checks for the rest."""

import pytest

import __spark_entry__ as registry
import oracle

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_yields_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_statement_has_a_query():
    assert not set(SQL) - set(QUERIES)


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns[:3] == ["pickup_date", "pickup_hour", "pickup_year"]
    assert result.count() > 0
