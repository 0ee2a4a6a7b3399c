import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures import frame, texts  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return texts()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
