from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripwell.session import build_session

    session = build_session("tests", "local[8]", 8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL
