"""Every SQL of this subpackage against its query: names, types and rows."""

import os

import pytest
from compare import compare, connect

from voltlake.llm.queries import ORACLE, QUERIES

ROOT = "/root/testdata"

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test data")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    sf_dir = f"{ROOT}/{sf}"
    assert compare(spark, connect(sf_dir), QUERIES[name], ORACLE[name], sf_dir) is None


def test_a_column_that_the_sql_lacks_is_seen(spark):
    sf_dir = f"{ROOT}/sf0.001"
    wider = lambda s, d: QUERIES["op8_substring_dedup"](s, d).selectExpr("*", "1 AS one")
    assert "types" in compare(spark, connect(sf_dir), wider, ORACLE["op8_substring_dedup"], sf_dir)
