import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.sql.files.maxPartitionBytes": "4m"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def plan_of():
    """Text of the physical plan of a frame."""
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
