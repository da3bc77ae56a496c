"""Cases that once went wrong."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tabprep.errors import KeyColumnError
from tabprep.operators import ranks
from tabprep.operators.folds import fit_stratified_folds, stratified_folds
from tabprep.operators.frame import LabelledTable, scores_to_wide
from tabprep.operators.impute import fit_imputer
from tabprep.operators.models import LinearClassifier, fit_logistic
from tabprep.operators.profile import describe, summary
from tabprep.sources import scan_csv, write_csv


def test_white_space_survives_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "  a "), (2, "b\t"), (3, " ")], "id bigint, s string")
    path = write_csv(df, str(tmp_path / "t"))
    assert rows(scan_csv(spark, path, df.schema), "id") == [(1, "  a "), (2, "b\t"), (3, " ")]


def test_inference_of_truth_values_and_infinities(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("a,b,c,d,e\nTrue,inf,True,1,true\nfalse,-Infinity,x,True,\nTRUE,2.5,false,False,FALSE\n")
    df = scan_csv(spark, str(file))
    assert dict(df.dtypes) == {"a": "boolean", "b": "double", "c": "string", "d": "string", "e": "boolean"}
    assert sorted(r.b for r in df.collect()) == [-math.inf, 2.5, math.inf]
    assert sorted((r.a, r.e is None) for r in df.collect()) == [(False, True), (True, False), (True, False)]


def test_imputer_type_does_not_follow_the_data(spark):
    for values in ([(None,), (None,)], [(1,), (None,)]):
        df = spark.createDataFrame(values, "a int")
        assert dict(fit_imputer(df, "mean", 1).transform(df).dtypes) == {"a": "double"}
        assert dict(fit_imputer(df, "mean", 0).transform(df).dtypes) == {"a": "int"}


def test_repeated_keys_raise(spark):
    table = LabelledTable(spark.createDataFrame([(1, 0)], "id bigint, y int"), "y")
    other = spark.createDataFrame([(1, 1), (1, 0)], "id bigint, y int")
    with pytest.raises(Exception, match="key id repeats: 1"):
        table.with_label_from(other, "id").frame.collect()


def test_features_left_out_raise(spark):
    scores = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "feature string, score double")
    with pytest.raises(Exception, match="without a column"):
        scores_to_wide(scores, ["a"]).collect()


@pytest.mark.parametrize("classes", [5, 30])
def test_folds_refuse_repeated_keys_at_any_number_of_classes(spark, classes):
    df = spark.range(2000).selectExpr("id", f"id % {classes} AS y")
    assert stratified_folds(df, "y", "id").count() == 2000
    repeated = df.union(spark.createDataFrame([(7, 7 % classes)], "id bigint, y bigint"))
    with pytest.raises(KeyColumnError):
        stratified_folds(repeated, "y", "id")
    if classes == 5:
        with pytest.raises(KeyColumnError):
            fit_stratified_folds(repeated, "y", "id")


def test_quantiles_with_infinities(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, math.inf, math.inf, math.inf)], "a double")
    row = describe(df).first()
    assert row.p50 == math.inf and row.p75 == math.inf


def test_rank_bounds_reach_the_scan(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.range(20_000).selectExpr("id", "CAST(id * 7919 % 20000 AS double) AS v", "id % 3 AS y").write.parquet(path)
    plans = []
    real = ranks._inside_any

    def spy(df, values, spans):
        out = real(df, values, spans)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(ranks, "_inside_any", spy)
    describe(spark.read.parquet(path).select("v"), finish_rows=50)
    stratified_folds(spark.read.parquet(path), "y", "id", finish_rows=50)
    assert any("GreaterThan(v," in p and "LessThan(v," in p for p in plans)
    assert any("GreaterThan(id," in p and "LessThan(id," in p for p in plans)


def test_summary_counts_missing_in_the_first_scan(spark):
    df = spark.createDataFrame([(1.0, None), (None, "x"), (3.0, None)], "a double, s string")
    assert {r["column"]: r.n_missing for r in summary(df).collect()} == {"a": 1, "s": 2}
    assert {r["column"]: r.n_missing for r in summary(df.select("s")).collect()} == {"s": 2}


def test_missing_features_raise_when_scoring_too(spark):
    model = LinearClassifier(("a",), (1.0,), 0.0)
    df = spark.createDataFrame([(1.0,), (None,)], "a double")
    with pytest.raises(Exception, match="must not be missing"):
        model.transform(df).select(F.sum("prediction")).collect()
    trained = fit_logistic(spark.createDataFrame([(1.0, 0), (2.0, 1)], "a double, y int"), ["a"], "y")
    assert trained.features == ("a",)


def test_near_quartiles(spark):
    df = spark.range(1001).selectExpr("CAST(id AS double) AS a", "CAST(NULL AS double) AS b")
    row, empty = describe(df, exact=False).orderBy("column").collect()
    assert (row["count"], row.mean, row.min, row.max) == (1001, 500.0, 0.0, 1000.0)
    assert [abs(q - e) < 2 for q, e in zip((row.p25, row.p50, row.p75), (250, 500, 750))] == [True] * 3
    assert empty["count"] == 0 and empty.p50 is None
