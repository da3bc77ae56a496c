"""Every registered query against its SQL, or against its own promises."""

import math
import re

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as contract
from tabprep.plans.oracle import ORACLE
from tabprep.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DUCK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "SMALLINT": "smallint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/sf0.001/{name}.parquet'")
    return connection


def key(row):
    return tuple((v is None, str(round(v, 3)) if isinstance(v, float) else str(v)) for v in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf, duck, name):
    frame = QUERIES[name](spark, sf)
    cursor = duck.execute(ORACLE[name])
    types = {d[0]: DUCK_TYPES[str(d[1])] for d in cursor.description}
    assert dict(frame.dtypes) == types
    names = sorted(types)
    order = [[d[0] for d in cursor.description].index(n) for n in names]
    expected = sorted(([row[i] for i in order] for row in cursor.fetchall()), key=key)
    got = sorted(([row[n] for n in names] for row in frame.collect()), key=key)
    assert len(got) == len(expected) > 0
    for a, b in zip(got, expected):
        for x, y in zip(a, b):
            same = math.isclose(x, y, rel_tol=1e-9, abs_tol=1.1e-6) if isinstance(x, float) and y is not None else x == y
            assert same, (name, a, b)


def test_only_fitted_numbers_have_no_sql():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"logistic_coefficients", "logistic_probabilities", "grid_results", "forest_importances"}


@pytest.mark.parametrize("name", ["logistic_submission", "grid_submission", "forest_submission", "network_submission", "boosting_submission"])
def test_no_submission_is_constant(duck, name):
    predicted = {r[1] for r in duck.execute(ORACLE[name]).fetchall()}
    assert predicted == {0, 1}


def test_model_reports(spark, sf):
    wide = QUERIES["logistic_coefficients"](spark, sf)
    assert wide.count() == 1 and "n_chars" in wide.columns
    importances = QUERIES["forest_importances"](spark, sf).collect()
    assert sum(r["score"] for r in importances) == pytest.approx(1, abs=0.02)
    chances = QUERIES["logistic_probabilities"](spark, sf).collect()
    assert all(r["continental_0"] + r["continental_1"] == pytest.approx(1, abs=0.0011) for r in chances)


def test_grid_learns_the_orders_rule(spark, sf):
    table = QUERIES["grid_results"](spark, sf).collect()
    assert len(table) == 70
    assert max(r["mean_test_score"] for r in table) >= 0.95
    assert min(r["rank_test_score"] for r in table) == 1


def test_entry(spark):
    assert contract.entry(spark).count() == 6000
