import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from trialspark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8, "trialspark-tests", driver_memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
