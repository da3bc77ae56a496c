import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TESTDATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tabprep-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf(spark):
    return str(TESTDATA / "sf0.001")


TRAIN_ROWS = [
    (1, 0, 3, "male", 22.0, 1, 0, 7.25, "S"),
    (2, 1, 1, "female", 38.0, 1, 0, 71.5, "C"),
    (3, 1, 3, "female", None, 0, 0, 8.0, "S"),
    (4, 1, 1, "female", 35.0, 1, 0, 53.0, "S"),
    (5, 0, 3, "male", None, 0, 0, 8.5, "Q"),
    (6, 0, 2, "male", 54.0, 0, 2, 52.0, None),
    (7, 0, 3, "male", 2.0, 3, 1, 21.0, "S"),
    (8, 1, 2, "female", 27.0, 0, 2, 11.0, "C"),
]
TEST_ROWS = [
    (101, 3, "male", 34.0, 0, 0, 7.5, "Q"),
    (102, 2, "female", None, 1, 0, None, "S"),
    (103, 2, "male", 62.0, 0, 0, 9.5, "X"),
]
FEATURES = "Pclass int, Sex string, Age double, SibSp int, Parch int, Fare double, Embarked string"
COLUMNS = ["Pclass", "Sex", "Age", "SibSp", "Parch", "Fare", "Embarked"]
ENCODE = ["Pclass", "Sex", "Embarked"]


@pytest.fixture(scope="session")
def train(spark):
    return spark.createDataFrame(TRAIN_ROWS, "PassengerId bigint, Survived int, " + FEATURES)


@pytest.fixture(scope="session")
def test(spark):
    return spark.createDataFrame(TEST_ROWS, "PassengerId bigint, " + FEATURES)


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (or as they come)."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
