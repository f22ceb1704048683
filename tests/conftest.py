from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that needs an OS path."""
    return path[5:] if path.startswith("file:") else path


@pytest.fixture(scope="session")
def spark():
    from streammetrics.session import build_session, work_dir
    s = build_session("local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    work_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from oracle_check import duck as make
    return make(SMALL)


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
