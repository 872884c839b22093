import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session

    s = get_session("*")
    yield s


def edges_df(spark, pairs):
    return spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")


def ids_df(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id BIGINT")
