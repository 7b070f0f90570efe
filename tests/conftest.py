import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folioforge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="folioforge-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_(tmp_path_factory):
    return tempfile.mkdtemp(prefix="ff-", dir=str(tmp_path_factory.getbasetemp()))
