import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = os.environ.get("SNAPMART_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from snapmart.session import build_session

    s = build_session(master="local[*]", app_name="snapmart-tests", shuffle_partitions=8,
                      driver_memory="8g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return os.path.join(TESTDATA, "sf0.001")


@pytest.fixture(scope="session")
def sf_check():
    return os.path.join(TESTDATA, "sf0.01")


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
