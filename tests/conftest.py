import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import build_session

    s = build_session(app_name="tidewatch-tests", master="local[8]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's shared root for one test."""
    from tidewatch.session import scratch_path

    return scratch_path(spark, "test")
