from __future__ import annotations

import os

import pytest

from cohortry.session import local_session
from tests.oracle import connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    return connect(SF)
