"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as contract
from lakelog.plans.oracles import statements
from lakelog.plans.queries import QUERIES
from tests.compare import connect, same

ORACLES = statements()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    same(QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLES[name]).df())
