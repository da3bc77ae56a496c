import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabprep.operators.models import fit_logistic
from tabprep.operators.encode import fit_one_hot
from tabprep.operators.sparse import fit_sparse_logistic, fit_sparse_one_hot

SCHEMA = "id int, `k.1` string, c1 double, y int"
ROWS = [(1, "b", 2.0, 1), (2, "a", None, 0), (3, None, 10.0, 1), (4, "a", 2.0, 0), (5, "", float("nan"), 1)]


@pytest.mark.parametrize("missing", ["zeros", "category"])
def test_vectors(spark, missing):
    df = spark.createDataFrame(ROWS, SCHEMA)
    fitted = fit_sparse_one_hot(df, ["k.1", "c1"], missing)
    found = {(r["column"], r["value"]): r["slot"] for r in fitted.vocabulary.collect()}
    values = {"k.1": ["", "a", "b"], "c1": ["10.0", "2.0"]}
    if missing == "category":
        values = {k: [*v, None] for k, v in values.items()}
    assert found == {(k, v): i for k, own in values.items() for i, v in enumerate(own)}
    test = df.unionAll(spark.createDataFrame([(9, "new", 3.0, 0)], SCHEMA))
    out = fitted.transform(test).withColumn("v", vector_to_array("indicators"))
    assert out.columns == [*df.columns, "indicators", "v"]
    text = {2.0: "2.0", 10.0: "10.0"}
    for r in out.collect():
        own = {"k.1": r["k.1"], "c1": text.get(r["c1"]) if r["c1"] != 3.0 else "3.0"}
        assert r["v"] == [float(own[k] == v) for k, vs in values.items() for v in vs]
    assert {(r["column"], r["value"]): r["n"] for r in fitted.counts(test).collect()}["k.1", "a"] == 2


def test_very_many_categories(spark):
    n = 100_000
    df = spark.range(n).select("id", F.concat(F.lit("user"), F.col("id") % n).alias("user"), (F.col("id") % 3).alias("kind"))
    fitted = fit_sparse_one_hot(df, ["user", "kind"])
    assert fitted.sizes == (n, 3)
    counts = fitted.counts(df.where("id % 2 = 0"))
    assert counts.groupBy("column").agg(F.sum("n").alias("n"), F.count("*").alias("c")).orderBy("column").collect() == [("kind", n // 2, 3), ("user", n // 2, n)]


def test_model_equals_the_dense_one(spark):
    dice = np.random.default_rng(3)
    rows = [(i, str(dice.integers(6)), float(dice.normal()), 0) for i in range(300)]
    df = spark.createDataFrame([(i, k, x, int((k in "024") ^ (dice.random() < 0.1))) for i, k, x, _ in rows], "id int, k string, x double, y int")
    sparse = fit_sparse_logistic(df, ["x"], ["k"], "y")
    dense = fit_one_hot(df, ["k"]).transform(df)
    other = fit_logistic(dense, ["x", *[f"k_{i}" for i in range(6)]], "y")
    assert {r["value"]: r["score"] for r in sparse.scores().collect()} == pytest.approx({str(i): c for i, c in enumerate(other.coefficients[1:])}, abs=1e-4)
    scored = sparse.transform(df)
    assert scored.columns == [*df.columns, "probability", "prediction"]
    both = scored.select("id", F.col("probability")[1].alias("p")).join(other.transform(dense).select("id", F.col("probability")[1].alias("q")), "id")
    assert both.where("abs(p - q) > 1e-4").count() == 0


def test_odd_tables(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    nothing = fit_sparse_one_hot(df.where("id = 2"), ["c1"])
    assert nothing.sizes == (0,)
    with pytest.raises(ValueError):
        fit_sparse_one_hot(df, ["c1"], "other")
    assert fit_sparse_one_hot(df, ["k.1"]).transform(df.limit(0)).count() == 0
