import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from propensity.session import local_session
    s = local_session(4, shuffle_partitions=4)
    yield s
    s.stop()
