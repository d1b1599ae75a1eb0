import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from arealens.session import get_session

    s = get_session(master="local[4]", shuffle_partitions=4, app_name="arealens-tests")
    yield s
    s.stop()
