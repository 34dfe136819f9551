import os
import sys
import tempfile
import time

import pytest

# collect() turns instants into Python datetimes in the process's local zone;
# the expected values here are UTC wall clocks.
os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillflow.runtime import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", partitions=8, app="tillflow-tests")
    yield s


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="tillflow-test-")
