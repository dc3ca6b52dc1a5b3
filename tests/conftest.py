from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clickloom.session import build_session  # noqa: E402
from events import make_events  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("clickloom-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false",
        "spark.driver.memory": "6g", "spark.log.level": "ERROR",
    })
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    return lambda *rows: make_events(spark, rows)
