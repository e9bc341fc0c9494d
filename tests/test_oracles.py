"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

from check_oracles import compare, connect
from workload import load

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() >= 0
