import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallywell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir="/tmp/tallywell-warehouse")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
