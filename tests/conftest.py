import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="ledgerlake-tests")
    yield s
    s.stop()
