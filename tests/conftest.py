import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from tidalfed.session import local_session

    return local_session("8", "tests")


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{DATA}/sf0.01"
