import os

import pytest


@pytest.fixture(scope="session")
def sf():
    path = "/root/testdata/sf0.001"
    if not os.path.exists(path):
        pytest.skip("test data missing")
    return path
