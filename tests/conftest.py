from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from targetlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Every join shuffles, so the paths for large lookups are the ones that run."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


@pytest.fixture
def every_key_hot(monkeypatch):
    """Keys count as hot from a few rows on."""
    from targetlens.operators import joins

    find = joins.find_hot_keys
    monkeypatch.setattr(joins, "find_hot_keys", lambda df, on, fewest_rows=2: find(df, on, 2))
