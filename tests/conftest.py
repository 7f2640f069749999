import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from reconlake.session import local_session, ship_package

    s = local_session(4, partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    return s


@pytest.fixture()
def data():
    return "/root/testdata/sf0.001"
