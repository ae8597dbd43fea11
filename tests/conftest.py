import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import local_session

    return local_session(4, 4)


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables here")
    return SMALL


@pytest.fixture(scope="session")
def larger(data):
    """Ten times the tables: SQL is compared here."""
    path = data.replace("sf0.001", "sf0.01")
    return path if os.path.isdir(path) else data
