import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tabprep.errors import CardinalityError, ColumnConflictError, KeyColumnError
from tabprep.operators.align import join_by_key, positional_concat, with_row_index
from tabprep.operators.folds import (
    evenly_spaced,
    fit_stratified_folds,
    fold_sizes,
    log_spaced,
    parameter_grid,
    stratified_folds,
)


def dealt(labels, n_folds):
    """Published rule: deal label-sorted rows in turn, then give each class's rows out in blocks."""
    labels = np.asarray(labels)
    order = list(dict.fromkeys(labels.tolist()))
    codes = np.array([order.index(v) for v in labels.tolist()])
    dealt_codes = np.sort(codes)
    allocation = np.array([np.bincount(dealt_codes[i::n_folds], minlength=len(order)) for i in range(n_folds)])
    folds = np.empty(len(labels), int)
    for c in range(len(order)):
        folds[codes == c] = np.repeat(np.arange(n_folds), allocation[:, c])
    return folds


def test_fold_sizes():
    assert fold_sizes([549, 342], 5) == [[110, 110, 110, 110, 109], [69, 68, 68, 68, 69]]


@pytest.mark.parametrize("as_text", [False, True])
@pytest.mark.parametrize("shares", [[0.7, 0.3], [0.2, 0.5, 0.3], [0.98, 0.02], [1 / 40] * 40])
def test_folds_follow_the_rule(spark, as_text, shares):
    rng = np.random.default_rng(len(shares))
    n = 700
    keys = np.sort(rng.choice(10**9, n, replace=False))
    labels = rng.choice(len(shares), n, p=shares)
    expected = dealt(labels, 5)
    data = [(f"{k:010d}" if as_text else int(k), int(v)) for k, v in zip(keys, labels)]
    df = spark.createDataFrame(data, f"k {'string' if as_text else 'bigint'}, y int").repartition(5)
    got = rows(stratified_folds(df, "y", "k"), "k")
    assert [r[2] for r in got] == expected.tolist()


def test_folds_with_few_rows_and_small_spans(spark):
    labels = [0, 1, 1, 0, 0, 1, 0, 0, 1, 2, 0, 2]
    df = spark.createDataFrame(list(enumerate(labels)), "k bigint, y int")
    fitted = fit_stratified_folds(df, "y", "k", 5, finish_rows=0)
    assert [r[2] for r in rows(fitted.transform(df), "k")] == dealt(labels, 5).tolist()


def test_folds_refuse_bad_keys(spark):
    with pytest.raises(KeyColumnError):
        stratified_folds(spark.range(100).selectExpr("id div 50 as k", "0 as y"), "y", "k")
    with pytest.raises(KeyColumnError):
        stratified_folds(spark.range(10).selectExpr("nullif(id, 3) as k", "0 as y"), "y", "k")
    with pytest.raises(CardinalityError):
        stratified_folds(spark.range(100).selectExpr("id as k", "id as y"), "y", "k", max_classes=99)


def test_assigning_folds_needs_no_shuffle(spark):
    df = spark.range(1000).selectExpr("id as k", "cast(id % 3 = 0 as int) as y")
    plan = stratified_folds(df, "y", "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_grid():
    grid = parameter_grid({"C": log_spaced(-3, 3, 7), "max_iter": evenly_spaced(100, 1000, 10)})
    assert len(grid) == 70
    assert grid[0] == {"C": 0.001, "max_iter": 100} and grid[9] == {"C": 0.001, "max_iter": 1000}
    assert grid[10]["C"] == 0.01 and grid[-1] == {"C": 1000.0, "max_iter": 1000}


def test_row_index(spark):
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 * 3 as k", "id as v").repartition(7)
    got = rows(with_row_index(df, "k", partitions=6), "k")
    assert [r[2] for r in got] == list(range(5000))
    two = spark.range(60).selectExpr("id % 3 as a", "id as b")
    got = rows(with_row_index(two, ["a", "b"]), "a", "b")
    assert [r[2] for r in got] == list(range(60))


def test_row_index_refuses_bad_keys(spark):
    with pytest.raises(KeyColumnError):
        with_row_index(spark.range(100).selectExpr("id % 99 as k"), "k")
    with pytest.raises(KeyColumnError):
        with_row_index(spark.range(100).selectExpr("nullif(id, 5) as k"), "k")


def test_row_index_shuffles_once(spark, monkeypatch):
    import tabprep.operators.align as align

    plans = []
    real = align.materialize

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(align, "materialize", spy)
    with_row_index(spark.range(100).selectExpr("id as k", "id * 2 as v"), "k")
    assert plans[0].count("Exchange") == 1 and "rangepartitioning" in plans[0]


def test_positional_concat(spark):
    left = spark.createDataFrame([(1, 1), (2, 2)], "lk int, a int")
    right = spark.createDataFrame([(9, 5)], "rk int, b int")
    assert rows(positional_concat(left, right, "lk", "rk"), "lk") == [(1, 1, 9, 5), (2, 2, None, None)]
    assert positional_concat(left, right, "lk", "rk", position=1).columns == ["lk", "rk", "b", "a"]
    with pytest.raises(ColumnConflictError):
        positional_concat(left, left, "lk", "lk")
    assert rows(join_by_key(left, right.withColumnRenamed("rk", "lk").withColumn("lk", F.lit(2)), "lk"), "lk") == [(1, 1, None), (2, 2, 5)]
    with pytest.raises(Exception, match="key lk repeats"):
        join_by_key(left, left.unionAll(left).withColumnRenamed("l", "other"), "lk").collect()


def test_columns_named_like_helpers(spark):
    names = ["__row", "__key0", "__tag", "__bad", "__part", "__offset", "__fold", "__label", "__cuts", "__p", "__f0", "__weight", "__Row"]
    df = spark.range(60).select("id", (F.col("id") % 3).alias("y"), *[F.lit(float(i)).alias(n) for i, n in enumerate(names[:-1])])
    numbered = with_row_index(df, "id")
    assert [r.row_index for r in numbered.orderBy("id").collect()] == list(range(60)) and numbered.columns == [*df.columns, "row_index"]
    other = spark.range(60).withColumnRenamed("id", "k")
    both = positional_concat(df, other, "id", "k")
    assert both.where("id = k").count() == 60 and both.columns == [*df.columns, "k"]
    texts = df.withColumn("id", F.col("id").cast("string"))  # numbered, not cut
    assert stratified_folds(texts, "y", "id").columns == [*df.columns, "fold"]
    assert all(r[n] == float(i) for r in both.collect() for i, n in enumerate(names[:-1]))
