from __future__ import annotations

import os
import sys
import tempfile

import pytest

TESTS = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [TESTS, os.path.dirname(TESTS)]


@pytest.fixture(scope="session")
def spark():
    from atelier.session import get_session

    session = get_session(
        master="local[4]",
        shuffle_partitions=8,
        driver_memory="16g",
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="atelier-test-ckpt-")},
    )
    yield session


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="atelier-test-")
