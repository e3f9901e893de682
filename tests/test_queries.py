"""Every registered query against its SQL over whole tables."""

import pytest

import __spark_entry__ as contract
from tests.compare import assert_same, oracle

SF = "/root/testdata/sf0.01"
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert_same(df, con, ORACLES[name])
    else:
        assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 2290
