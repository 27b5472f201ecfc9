import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from citystream.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def no_bound_is_left(request):
    """Pipeline stages bound the session's Arrow batches; the next test begins without."""
    yield
    if "spark" in request.fixturenames:
        from citystream.session import ARROW_BYTES_CONF
        request.getfixturevalue("spark").conf.unset(ARROW_BYTES_CONF)
