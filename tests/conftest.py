import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfline.session import build_session

    session = build_session(
        "shelfline-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_lake(spark):
    from shelfline.plans.registry import lake_of

    return lake_of(spark, SMALL)


@pytest.fixture(scope="session")
def day():
    """Date from an ISO text."""
    return dt.date.fromisoformat
