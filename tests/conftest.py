import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, use_subdir
    s = build_session(master="local[4]", shuffle_partitions=4)
    use_subdir(s, f"tests-{uuid.uuid4().hex[:10]}")
    yield s
    s.stop()


@pytest.fixture
def fresh(spark):
    """A new, unused folder below the work root for one test."""
    from tidemark.session import work_path
    return work_path(spark, f"t-{uuid.uuid4().hex[:10]}")
