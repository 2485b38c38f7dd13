import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session("tests", 8, 8)
    s.sparkContext.setLogLevel("ERROR")
    return s
