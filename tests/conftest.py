import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import get_session
    ckpt = tempfile.mkdtemp(prefix="cadenza-test-ckpt-")
    s = get_session("local[4]", app="cadenza-tests", shuffle_partitions=4,
                    **{"spark__checkpoint__dir": ckpt})
    yield s
    s.stop()
