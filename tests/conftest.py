import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    return local_session(8, "tidemark-tests")


@pytest.fixture
def folder(spark):
    """A new path below the shared folder."""
    from tidemark.session import scratch

    return scratch(spark, "test")
