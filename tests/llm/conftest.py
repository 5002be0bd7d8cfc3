import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from helpers import DOC_SCHEMA, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOC_SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """All rows of the smallest documents table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
