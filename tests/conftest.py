import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from claimflow.conf import tune  # noqa: E402
from session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return tune(local_session())


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
