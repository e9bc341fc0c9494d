import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalograph.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", 4, "4g", "tests")
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression over one literal row."""
    def value(column, **row):
        if row:
            frame = spark.createDataFrame([tuple(row.values())], _ddl(row))
        else:
            frame = spark.range(1)
        return frame.select(column.alias("v")).first()["v"]
    return value


def _ddl(row):
    kinds = {str: "string", int: "int", float: "double", list: "array<string>", type(None): "string"}
    return ", ".join(f"`{name}` {kinds[type(v)]}" for name, v in row.items())
