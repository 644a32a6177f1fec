import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from farebox.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("farebox-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder for each test."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
