import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from recurra.session import HOT_KEY_ROWS, build_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hot_limit(spark):
    """Set the hot-key limit for one test."""
    yield lambda rows: spark.conf.set(HOT_KEY_ROWS, str(rows))
    spark.conf.unset(HOT_KEY_ROWS)
