from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import local_session

    return local_session("tests", 8, 4)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def folder():
    """A new folder per test; nothing is cleared."""
    return tempfile.mkdtemp(prefix="ledgerlake-test-", dir="/tmp")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def as_dicts(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
