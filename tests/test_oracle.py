"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tillroll import registry

from .conftest import SF_SMALL
from .helpers import duck, same

registry.load_all()
QUERIES = {name: E.queries()[name] for name in registry.QUERIES}
ORACLE = {name: E.oracle_sql()[name] for name in registry.ORACLE}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert missing == [], f"queries without oracle: {missing}"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, detail = same(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "total_revenue" in df.columns
