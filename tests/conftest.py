import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
# Tests bring their own folder for intermediate tables.
os.environ.setdefault("EBBTIDE_SCRATCH", tempfile.mkdtemp(prefix="ebbtide-"))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from ebbtide.session import local_session

    session = local_session("tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture
def rows():
    """Rows of a frame as a set-comparable, sorted list of tuples."""

    def read(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return read
