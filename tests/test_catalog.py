"""Every query of the catalog against its SQL oracle."""

import pytest

import __spark_entry__ as contract
from ludomart.catalog import ORACLE, QUERIES
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["game_name", "year", "month", "n_reviews", "avg_rating"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(oracle, df, ORACLE[name]) == []
