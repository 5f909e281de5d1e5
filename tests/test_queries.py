import os

import pytest
from compare import connect, difference

import __spark_entry__ as entry_module
from gaugeworks.plans.oracle import ORACLES
from gaugeworks.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_module.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, duck, ORACLES[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
