import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidevault.session import local_session, work_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    yield session
    session.stop()


@pytest.fixture
def root(spark):
    """A fresh folder for a table."""
    return work_dir(spark, "test")
