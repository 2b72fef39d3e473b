"""Every registered query against its DuckDB counterpart on the smallest data."""

import __spark_entry__ as contract
import pytest
from check_oracle import difference, duck

from greenwave.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(contract.ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, name):
    assert difference(spark, con, name, SF) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 745
