import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def sf_small():
    path = "/root/testdata/sf0.001"
    if not os.path.exists(path):
        pytest.skip("driver test data not present")
    return path
