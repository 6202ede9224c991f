"""Every registered query against independent SQL, over whole tables."""

import pytest
from oracle_compare import difference, duck

import __spark_entry__ as contract
from civitally.plans.oracles import ORACLES
from civitally.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert difference(df, con, contract.oracle_sql()[name]) is None
