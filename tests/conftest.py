import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session("ledgerloom-tests", 8, "6g")


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
