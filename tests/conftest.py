import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from conceptlink.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, partitions=4, memory="6g")


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
