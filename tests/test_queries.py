"""Every registered query against its SQL."""

import pytest

from gridloom.plans import registry

from .compare import check, connect

SQL = registry.oracle_sql()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    check(QUERIES[name](spark, sf), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
