import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import AWKWARD, DOCS  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
