import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from harborline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ops(spark):
    """The operational tables of the smallest scale folder."""
    from harborline.sources.tables import OpsTables

    return OpsTables(spark, "/root/testdata/sf0.001")


@pytest.fixture()
def frame(spark):
    """Build a frame from a DDL schema and rows."""
    def build(schema, rows):
        return spark.createDataFrame(rows, schema)

    return build
