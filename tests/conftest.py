import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from auric.session import get_session
    s = get_session("local[4]", app="auric-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from auric.session import scratch_path
    return scratch_path(spark, "test")
