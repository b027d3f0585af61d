import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spindle.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 8, "spindle-tests")
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="spindle-test-")


# Micro-corpus: two rows share title A, D has no valid token.
MICRO_DOCS = [
    ("A", "The cat's hat, the HAT!"),
    ("A", "hat again"),
    ("B", "hello world hello"),
    ("C", "world-wide world foo,bar"),
    ("D", "x y !"),
    ("E", "hat hello the end"),
    ("F", "end note"),
]


@pytest.fixture()
def micro(spark):
    return spark.createDataFrame(MICRO_DOCS, "title string, text string")
