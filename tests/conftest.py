from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.session import local_session  # noqa: E402

TABLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tablewright-tests")


@pytest.fixture(scope="session")
def tables():
    return TABLES


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tablewright-test-", dir="/tmp")
