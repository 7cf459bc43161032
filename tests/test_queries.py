"""Every registered query against its SQL, on the smallest and the middle data set."""

import os

import pytest

import __spark_entry__ as contract
from compare import compare, connect
from voltlake.plans.oracle import ORACLE
from voltlake.plans.queries import QUERIES

ROOT = "/root/testdata"
SMALL = f"{ROOT}/sf0.001"
MIDDLE = f"{ROOT}/sf0.01"

LIBRARY = sorted(QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("sf_dir", [SMALL, MIDDLE])
@pytest.mark.parametrize("name", LIBRARY)
def test_query_equals_sql(spark, sf_dir, name):
    connection = connect(sf_dir)
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    assert compare(spark, connection, query, sql, sf_dir) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["id_chargingpoint", "status", "n", "share"]
    assert df.count() > 0
