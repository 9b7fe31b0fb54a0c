import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session
    s = build_session("local[4]", 8, app_name="quarry-tests")
    yield s
    s.stop()
