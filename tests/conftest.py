import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = os.environ.get("RIDELAKE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from ridelake.session import build_session

    # scratch goes to the session's spark.checkpoint.dir; build_session sets
    # a temporary one only when the environment names none
    s = build_session("local[8]", 8, app_name="ridelake-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
