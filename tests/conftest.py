import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from duskwatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
