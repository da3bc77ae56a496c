"""The session is the one of the other tests."""

import pytest


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
