import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from penprint.session import local_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(TESTDATA):
        pytest.skip("test tables not present")
    return TESTDATA
