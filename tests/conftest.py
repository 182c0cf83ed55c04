import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from eventwin.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
                            spark_driver_memory="6g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
