from decimal import Decimal

import pytest
from conftest import COLUMNS, ENCODE, rows
from pyspark.sql import functions as F

from tabprep.errors import CardinalityError, ColumnConflictError, SchemaMismatchError
from tabprep.operators.encode import fit_one_hot
from tabprep.operators.frame import select_columns
from tabprep.operators.impute import fit_imputer
from tabprep.operators.prepare import fit_column_transformer, fit_preparation, prepare_pair
from tabprep.operators.scale import fit_min_max, fit_standard

TRAIN_NAMES = (
    "Pclass_1,Pclass_2,Pclass_3,Sex_female,Sex_male,Age,SibSp,Parch,Fare,Embarked_C,Embarked_Q,Embarked_S".split(",")
)
TRAIN_READY = [
    (0, 0, 1, 0, 1, 22.0, 1, 0, 7.25, 0, 0, 1),
    (1, 0, 0, 1, 0, 38.0, 1, 0, 71.5, 1, 0, 0),
    (0, 0, 1, 1, 0, 29.7, 0, 0, 8.0, 0, 0, 1),
    (1, 0, 0, 1, 0, 35.0, 1, 0, 53.0, 0, 0, 1),
    (0, 0, 1, 0, 1, 29.7, 0, 0, 8.5, 0, 1, 0),
    (0, 1, 0, 0, 1, 54.0, 0, 2, 52.0, 0, 0, 0),
    (0, 0, 1, 0, 1, 2.0, 3, 1, 21.0, 0, 0, 1),
    (0, 1, 0, 1, 0, 27.0, 0, 2, 11.0, 1, 0, 0),
]


def test_preparation_fitted_on_train(train, test):
    fitted = fit_preparation(train, COLUMNS, ENCODE)
    assert fitted.feature_names == TRAIN_NAMES
    ready = fitted.transform(train, keys=["PassengerId"])
    assert ready.columns == ["PassengerId", *TRAIN_NAMES]
    assert [r[1:] for r in rows(ready, "PassengerId")] == TRAIN_READY
    other = rows(fitted.transform(test, keys=["PassengerId"]), "PassengerId")
    assert other[1] == (102, 0, 1, 0, 1, 0, 29.7, 1, 0, 29.0, 0, 0, 1)
    assert other[2][-3:] == (0, 0, 0)  # a category the train table did not have


def test_preparation_of_each_table_by_itself(train, test):
    fitted = fit_preparation(test, COLUMNS, ENCODE)
    assert fitted.feature_names == (
        "Pclass_2,Pclass_3,Sex_female,Sex_male,Age,SibSp,Parch,Fare,Embarked_Q,Embarked_S,Embarked_X".split(",")
    )
    assert rows(fitted.transform(test)) == [
        (0, 1, 0, 1, 34.0, 0, 0, 7.5, 1, 0, 0),
        (1, 0, 1, 0, 48.0, 1, 0, 8.5, 0, 1, 0),
        (1, 0, 0, 1, 62.0, 0, 0, 9.5, 0, 0, 1),
    ]
    with pytest.raises(SchemaMismatchError):
        prepare_pair(train, test, COLUMNS, ENCODE, per_frame=True)
    ready, other = prepare_pair(train, test, COLUMNS, ENCODE)
    assert ready.columns == other.columns


def test_transform_is_one_projection(train, spark, sf):
    fitted = fit_preparation(train, COLUMNS, ENCODE)
    plan = fitted.transform(train)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1 and "Join" not in plan and "Aggregate" not in plan


def test_column_transformer(train, test):
    numeric, categorical = ["Age", "Fare", "SibSp", "Parch"], ["Pclass", "Sex", "Embarked"]
    fitted = fit_column_transformer(train, numeric, categorical)
    assert fitted.feature_names == [
        *numeric, "Pclass_1", "Pclass_2", "Pclass_3", "Sex_female", "Sex_male",
        "Embarked_C", "Embarked_Q", "Embarked_S", "Embarked_nan",
    ]
    assert fitted.imputer.values["Age"] == 30.0
    own = fit_imputer(select_columns(test, [*numeric, *categorical]), "mean", 0)
    ready = rows(fitted.transform(test, ["PassengerId"], own), "PassengerId")
    expected = [
        (101, 0.3082, -0.8947, -0.7746, -0.7293),
        (102, 1.3233, -0.8739, 0.2582, -0.7293),
        (103, 2.3385, -0.8116, -0.7746, -0.7293),
    ]
    assert [(r[0], *(round(v, 4) for v in r[1:5])) for r in ready] == expected
    assert ready[2][-4:] == (0, 0, 0, 0)
    train_rows = rows(fitted.transform(train, ["PassengerId"]), "PassengerId")
    assert train_rows[5][-4:] == (0, 0, 0, 1)


def test_min_max_scale(train):
    ready = fit_preparation(train, COLUMNS, ENCODE).transform(train, ["PassengerId"])
    names = ["Age", "SibSp", "Parch", "Fare"]
    scaled = fit_min_max(ready, names).transform(ready).select("PassengerId", *names)
    assert [tuple(round(v, 4) for v in r) for r in rows(scaled, "PassengerId")] == [
        (1, 0.3846, 0.3333, 0, 0),
        (2, 0.6923, 0.3333, 0, 1),
        (3, 0.5327, 0, 0, 0.0117),
        (4, 0.6346, 0.3333, 0, 0.7121),
        (5, 0.5327, 0, 0, 0.0195),
        (6, 1, 0, 1, 0.6965),
        (7, 0, 1, 0.5, 0.214),
        (8, 0.4808, 0, 1, 0.0584),
    ]


def test_scaling_constants_and_outside_values(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5)], "a double, b int")
    later = spark.createDataFrame([(7.0, 6)], "a double, b int")
    assert rows(fit_min_max(df, ["a", "b"]).transform(later)) == [(3.0, 1.0)]
    assert rows(fit_standard(df, ["a", "b"]).transform(df)) == [(-1.0, 0.0), (1.0, 0.0)]


def test_one_hot_missing_rules(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (10, "a"), (None, "a")], "n bigint, s string")
    zeros = fit_one_hot(df, ["n", "s"])
    assert zeros.transform(df).columns == ["n_1", "n_2", "n_10", "s_a", "s_b"]
    category = fit_one_hot(df, ["s"], missing="category").transform(df)
    assert category.columns == ["n", "s_a", "s_b", "s_nan"]
    assert rows(category.agg(F.sum("s_nan"), F.sum(F.expr("s_a + s_b + s_nan")))) == [(1, 4)]


def test_one_hot_guards(spark):
    df = spark.range(50).selectExpr("id", "cast(id % 2 as string) as s", "1 as s_0")
    with pytest.raises(CardinalityError):
        fit_one_hot(df, ["id"], max_categories=10)
    with pytest.raises(CardinalityError):
        fit_one_hot(df, ["id", "s"], max_categories=49)
    assert len(fit_one_hot(df, ["id"], max_categories=50).vocabulary["id"]) == 50
    with pytest.raises(ColumnConflictError):
        fit_one_hot(df, ["s"]).transform(df)


def test_fill_methods(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "x"), (2, float("nan"), "y"), (None, None, "y"), (4, 2.0, None), (4, 10.0, "x")],
        "i int, d double, s string",
    )
    assert fit_imputer(df, "mean", 1).values == {"i": 2.8, "d": 4.3}
    assert fit_imputer(df, "mean", 0).values == {"i": 3.0, "d": 4.0}
    assert fit_imputer(df, "median").values == {"i": 3.0, "d": 2.0}
    assert fit_imputer(df, "mode").values == {"i": 4, "d": 1.0, "s": "x"}
    filled = fit_imputer(df, "mean", 1).transform(df)
    assert dict(filled.dtypes) == {"i": "double", "d": "double", "s": "string"}
    assert rows(filled.orderBy("i"))[2] == (2.8, 4.3, "y")
    whole = fit_imputer(df, "mean", 0).transform(df)
    assert dict(whole.dtypes)["i"] == "int"
    assert rows(fit_imputer(df, "mode").transform(df).agg(F.count("i"), F.count("d"), F.count("s"))) == [(5, 5, 5)]


def test_repartitioning_changes_nothing(train):
    a = fit_preparation(train, COLUMNS, ENCODE)
    b = fit_preparation(train.repartition(5), COLUMNS, ENCODE)
    assert a == b


@pytest.mark.parametrize("digits", [None, 0, 2])
def test_mean_fill_and_scale_in_one_scan(spark, digits):

    rows = [(i, None if i % 3 == 0 else 1e6 + i / 7, float("nan") if i % 5 == 0 else 4.0, i, Decimal(i % 9), "k") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, a double, `b.c` double, d bigint, e decimal(5,1), s string")
    names = ["a", "b.c", "d", "e"]
    found = fit_column_transformer(df, names, ["s"], digits)
    imputer = fit_imputer(df.select("a", "`b.c`", "d", "e", "s"), "mean", digits)
    scaler = fit_standard(imputer.transform(df.select("a", "`b.c`", "d", "e", "s")), names)
    assert found.imputer.values == pytest.approx(imputer.values)
    assert found.scaler.shift == pytest.approx(scaler.shift) and found.scaler.width == pytest.approx(scaler.width, rel=1e-9)
    with pytest.raises(ValueError):
        fit_column_transformer(df.withColumn("a", F.lit(None).cast("double")), ["a"], [])
