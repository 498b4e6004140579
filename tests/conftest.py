import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wrenchcast.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[*]", app_name="wrenchcast-tests", shuffle_partitions=8,
                          extra={"spark.sql.maxMetadataStringLength": "10000"})  # whole filter lists in plans
    yield session


@pytest.fixture()
def fleet_df(spark):
    """Six rows of an invented fleet: one without hours, one without the flag."""
    rows = [("zk-a", 8, 2.5, False), ("zk-b", 13, 0.75, True), ("zk-c", 21, 6.25, None),
            ("zk-d", 34, None, False), ("zk-e", 55, 9.0, True), ("zk-f", 40, 1.5, False)]
    return spark.createDataFrame(rows, "reg string, legs bigint, hours double, wet boolean")
