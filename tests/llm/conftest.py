import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(os.path.dirname(HERE))]

from llm_fixtures import SCHEMA, odd_rows  # noqa: E402


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
