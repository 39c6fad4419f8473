import pytest

from tessella.plans import catalogue
from tests.oracle import SF, check

QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    check(spark, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).collect()
