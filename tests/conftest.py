import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roasty.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="roasty-tests")
    yield s


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("roasty"))
