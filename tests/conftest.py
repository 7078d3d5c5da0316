import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sieveline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """DataFrame of dicts or tuples under a DDL schema."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
