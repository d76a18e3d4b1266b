import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("QUARRY_SCRATCH", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    from quarry.session import local_session
    s = local_session(4, shuffle_partitions=4, app="quarry-tests")
    yield s
    s.stop()
