import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from emberlog.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="8", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
