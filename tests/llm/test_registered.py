"""Every registered query runs; those with a SQL twin equal it."""

import pytest

from catalograph.llm.registry import load
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_each_operator_has_a_query():
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in QUERIES) == 1
    assert "pipeline" in QUERIES
