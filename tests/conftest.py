import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyward.session import build_session

    session = build_session(master="local[*]", shuffle_partitions=8, app_name="tallyward-tests")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from tallyward.session import fresh_dir

    return fresh_dir(spark, "pytest")
