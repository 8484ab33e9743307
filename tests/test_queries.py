"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import connect, differences, spark_result

from catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert differences(con, ORACLES[name], df) == []
    else:
        assert spark_result(df)[2]
