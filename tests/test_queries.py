"""Every registered query against its SQL, over the driver's tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract
from compare import connect, differences
from tsmedallion.plans.oracle import SQL
from tsmedallion.plans.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    with connect(SF_DIR) as con:
        yield con


def test_every_query_has_sql():
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, oracle, name):
    result = REGISTRY[name](spark, SF_DIR)
    assert differences(result, oracle, SQL[name]) == []


def test_entry_returns_the_fact(spark):
    fact = contract.entry(spark)
    assert fact.columns[:2] == ["indicator_id", "date_key"]
    assert fact.count() > 0
