from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fieldbook.session import get_session

    session = get_session("local[4]", 4, app_name="fieldbook-tests")
    yield session


@pytest.fixture(scope="session")
def fx(spark):
    from fieldbook.sources.fixtures import Fixtures

    return Fixtures(spark, SF001)


@pytest.fixture(scope="session")
def fx_small(spark):
    from fieldbook.sources.fixtures import Fixtures

    return Fixtures(spark, SF0001)
