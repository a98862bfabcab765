import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shipwise.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, app="shipwise-tests")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
