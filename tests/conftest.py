import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from monthwise.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="monthwise-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from monthwise.session import scratch_path

    return lambda name="t": scratch_path(spark, name)
