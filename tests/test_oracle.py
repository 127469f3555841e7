"""Every registered query against its oracle SQL."""

import pytest
from making import SF_SMALL

import __spark_entry__ as contract
from comparing import connect, differences
from meterlake.plans.catalogue import QUERIES
from meterlake_oracle.catalogue import ORACLE_SQL as ORACLE


@pytest.fixture(scope="module")
def duck():
    return connect(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_SMALL), duck, ORACLE[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() == 1
