from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

import __spark_entry__  # noqa: E402,F401  (ships the package's functions by value)
from pyspark import cloudpickle  # noqa: E402

from prefloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture(scope="session", autouse=True)
def _test_functions_by_value():
    """Responders defined in a test module reach the workers by value."""
    for name in ("test_completion", "test_ranking", "test_flows", "test_training", "test_ledger", "test_store", "test_sinks"):
        if name in sys.modules:
            cloudpickle.register_pickle_by_value(sys.modules[name])


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as sorted tuples, None first."""
    found = (tuple(r) for r in (df.select(*columns) if columns else df).collect())
    return sorted(found, key=lambda row: tuple((v is not None, v) for v in row))
