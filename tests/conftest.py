from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from emporia.session import local_session

    session = local_session("tests", cpus=os.environ.get("TEST_CPUS", "8"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
