from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from atmolake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions over one row of given texts."""

    def evaluate(*columns):
        return tuple(spark.range(1).select(*columns).first())

    return evaluate


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
