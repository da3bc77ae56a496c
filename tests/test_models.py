import numpy as np
import pytest
from conftest import COLUMNS, ENCODE, rows
from pyspark.sql import functions as F

from tabprep.operators.folds import stratified_folds
from tabprep.operators.models import (
    LinearClassifier,
    class_probabilities,
    fit_boosting,
    fit_forest,
    fit_logistic,
    fit_network,
    with_threshold,
)
from tabprep.operators.scoring import (
    best_candidate,
    candidate_results,
    round_scores,
    submission,
    with_prediction,
)
from tabprep.operators.tune import grid_search
from tabprep.plans import forest_predict, logistic_predict, network_predict, probabilities, tune_and_predict


def newton(x, y, w, C, steps=60):
    """Minimum of C * sum(w * logloss) + |coef|² / 2, intercept free."""
    x1 = np.column_stack([x, np.ones(len(x))])
    free = np.append(np.ones(x.shape[1]), 0.0)
    beta = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x1 @ beta))
        gradient = C * x1.T @ (w * (p - y)) + free * beta
        curvature = C * (x1 * (w * p * (1 - p))[:, None]).T @ x1 + np.diag(free)
        beta -= np.linalg.solve(curvature, gradient)
    return beta


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(5)
    n = 600
    x = np.column_stack([rng.normal(size=n) * 40 + 1000, rng.random(n), (rng.random(n) < 0.3).astype(float)])
    score = (x[:, 0] - 1000) / 40 + 2 * x[:, 1] - x[:, 2]
    y = (score + rng.logistic(size=n) > 0.8).astype(int)
    data = [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "id bigint, a double, b double, c double, y int").repartition(4).persist()
    yield df, x, y
    df.unpersist()


def best_possible(x, y):
    """Accuracy of the rule the labels were drawn from."""
    return (((x[:, 0] - 1000) / 40 + 2 * x[:, 1] - x[:, 2] > 0.8) == y).mean()


def scaled(x, rows_used=slice(None)):
    low, high = x[rows_used].min(axis=0), x[rows_used].max(axis=0)
    return (x - low) / (high - low)


@pytest.mark.parametrize("C,weights", [(1.0, None), (10.0, {0: 1.0, 1: 1.5})])
def test_logistic_reaches_the_published_minimum(noisy, C, weights):
    df, x, y = noisy
    model = fit_logistic(df, ["a", "b", "c"], "y", C, 1000, weights, scale=True, tol=1e-12)
    w = np.where(y == 1, 1.5, 1.0) if weights else np.ones(len(y))
    expected = newton(scaled(x), y, w, C)
    np.testing.assert_allclose([*model.coefficients, model.intercept], expected, rtol=1e-4)


def test_unscaled_logistic(noisy):
    df, x, y = noisy
    model = fit_logistic(df, ["a", "b", "c"], "y", C=10.0)
    assert model.scaler is None
    expected = newton(x, y, np.ones(len(y)), 10.0)
    np.testing.assert_allclose([*model.coefficients, model.intercept], expected, rtol=1e-6)


def test_many_features(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 60))
    y = (x[:, :3].sum(axis=1) + rng.logistic(size=500) > 0).astype(int)
    names = [f"f{i}" for i in range(60)]
    df = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(x, y)], [*names, "y"]).repartition(40)
    model = fit_logistic(df, names, "y", C=0.5)
    expected = newton(x, y, np.ones(500), 0.5)
    np.testing.assert_allclose([*model.coefficients, model.intercept], expected, rtol=1e-5, atol=1e-7)


def test_missing_features_raise(spark):
    df = spark.createDataFrame([(1.0, 0), (None, 1), (2.0, 1)], "a double, y int")
    with pytest.raises(Exception, match="must not be missing"):
        fit_logistic(df, ["a"], "y")
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        fit_logistic(df.where("a > 0").withColumn("y", F.lit(2)), ["a"], "y")


def test_scoring_with_many_features(spark):
    names = [f"f{i}" for i in range(700)]
    model = LinearClassifier(tuple(names), tuple(0.01 for _ in names), -3.5)
    df = spark.range(2).select("id", *[F.col("id").cast("double").alias(n) for n in names])
    assert [r["prediction"] for r in model.transform(df).orderBy("id").collect()] == [0.0, 1.0]


def test_grid_agrees_with_brute_force(noisy):
    df, x, y = noisy
    grid = {"C": [0.01, 1.0, 100.0], "max_iter": [100, 200]}
    weights = {0: 1.0, 1: 1.5}
    fast = grid_search(df, ["a", "b", "c"], "y", "id", grid, 5, weights)
    folds = np.array([r["fold"] for r in stratified_folds(df, "y", "id").orderBy("id").collect()])
    w = np.where(y == 1, 1.5, 1.0)
    table = {(r["param_C"], r["param_max_iter"]): r for r in fast.results.collect()}
    assert len(table) == 6
    for C in grid["C"]:
        scores = []
        for fold in range(5):
            used = folds != fold
            z = scaled(x, used)
            beta = newton(z[used], y[used], w[used], C)
            guess = z[~used] @ beta[:-1] + beta[-1] > 0
            scores.append((guess == y[~used]).mean())
        for m in grid["max_iter"]:
            got = [table[C, m][f"split{i}_test_score"] for i in range(5)]
            np.testing.assert_allclose(got, scores, atol=1e-12)
            assert table[C, m]["mean_test_score"] == pytest.approx(np.mean(scores))
            assert table[C, m]["std_test_score"] == pytest.approx(np.std(scores))
    expected = newton(scaled(x), y, w, fast.best["C"])
    np.testing.assert_allclose([*fast.model.coefficients, fast.model.intercept], expected, rtol=1e-6)


def test_grid_search_does_not_depend_on_partitions(noisy):
    df, _, _ = noisy
    grid = {"C": [0.1, 10.0], "max_iter": [100]}
    a = grid_search(df, ["a", "b"], "y", "id", grid)
    b = grid_search(df.repartition(9, "b"), ["a", "b"], "y", "id", grid)
    assert rows(a.results, "candidate") == rows(b.results, "candidate")
    np.testing.assert_allclose(a.model.coefficients, b.model.coefficients, rtol=1e-9)


def test_separable_labels_and_unstopped_solver(spark):
    # Values in no relation to the key: folds are blocks of keys.
    df = spark.range(200).selectExpr("id", "cast(id * 37 % 200 as double) as a", "1.0 as k")
    df = df.withColumn("y", F.expr("cast(a >= 90 as int)"))
    found = grid_search(df, ["a", "k"], "y", "id", {"C": [1000.0, 1e6], "max_iter": [1, 2, 500]}, n_folds=4)
    accuracies = {(r["param_C"], r["param_max_iter"]): r["mean_test_score"] for r in found.results.collect()}
    assert accuracies[1e6, 500] >= 0.97
    assert accuracies[1000.0, 1] <= accuracies[1000.0, 500]


def test_linear_scoring_is_an_expression(noisy):
    df, _, _ = noisy
    model = fit_logistic(df, ["a", "b", "c"], "y", 1.0, 50)
    scored = model.transform(df)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange rangepartitioning" not in plan
    sums = scored.agg(F.min(F.expr("probability[0] + probability[1]")), F.max(F.expr("probability[0] + probability[1]")))
    assert rows(sums) == [(1.0, 1.0)]


def test_forest_importances_and_seed(noisy):
    df, x, y = noisy
    model = fit_forest(df, ["a", "b", "c"], "y", n_trees=30, max_depth=4, seed=7)
    again = fit_forest(df, ["a", "b", "c"], "y", n_trees=30, max_depth=4, seed=7)
    scores = dict(rows(model.scores(df)))
    assert sum(scores.values()) == pytest.approx(1.0, abs=0.005)
    assert max(scores, key=scores.get) == "a"
    assert scores == dict(rows(again.scores(df)))
    right = model.transform(df).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert right > best_possible(x, y) - 0.05


@pytest.mark.parametrize("partitions", [1, 2, 8])
def test_forest_does_not_depend_on_the_layout(noisy, partitions):
    df, _, _ = noisy
    layouts = df, df.repartition(partitions, "b")
    one, other = (fit_forest(d, ["a", "b", "c"], "y", n_trees=10, max_depth=4, seed=7, key="id") for d in layouts)
    assert one.model.featureImportances == other.model.featureImportances
    assert [t.toDebugString.split("\n", 1)[1] for t in one.model.trees] == [t.toDebugString.split("\n", 1)[1] for t in other.model.trees]


def test_quasi_newton_steps_lead_to_the_same_answer(noisy, monkeypatch):
    import tabprep.operators.newton as newton_module

    df, _, _ = noisy
    grid = {"C": [0.1, 10.0], "max_iter": [100]}
    together = grid_search(df, ["a", "b"], "y", "id", grid)
    monkeypatch.setattr(newton_module, "CURVATURES", 1)
    apart = grid_search(df, ["a", "b"], "y", "id", grid)
    assert rows(together.results, "candidate") == rows(apart.results, "candidate")
    assert together.model.coefficients == pytest.approx(apart.model.coefficients, rel=1e-6)


def test_wide_tables_fit_in_one_pass_a_step(spark, monkeypatch):
    import tabprep.operators.newton as newton_module
    from tabprep.operators.newton import ALL_ROWS, RowBlocks, new_fit

    monkeypatch.setattr(newton_module, "CURVATURES", 1)
    dice = np.random.default_rng(6)
    n, d = 400, 200
    x = (dice.random((n, d)) < 0.1) * dice.uniform(0.5, 1.5, d)
    y = (x[:, :20].sum(axis=1) + dice.normal(0, 0.3, n) > x[:, :20].sum(axis=1).mean()).astype(float)
    df = spark.createDataFrame([(v.tolist(), float(t), i % 5) for i, (v, t) in enumerate(zip(x, y))], "v array<double>, y double, fold int")
    low, width = np.zeros(d), np.full(d, 2.0)
    fits = [new_fit(C, fold, low, np.ones(d)) for C in (0.1, 1.0) for fold in (ALL_ROWS, 0)]
    values = [F.col("v")[i] for i in range(d)]
    with RowBlocks(df, values, F.col("y"), F.lit(1.0), F.col("fold"), (low, width)) as blocks:
        blocks.fit(fits, 200, 1e-9)
    for f in fits:
        used = np.arange(n) % 5 != f.fold
        p = 1 / (1 + np.exp(-(x[used] @ f.point[:-1] + f.point[-1])))
        gradient = np.append(x[used].T @ (p - y[used]) + f.point[:-1] / f.C, (p - y[used]).sum())
        assert f.done and f.steps < 60 and np.abs(gradient).max() < 1e-6


def test_network_and_boosting_learn(noisy):
    df, x, y = noisy
    ready = df.selectExpr("id", "(a - 1000) / 40 as a", "b", "c", "y")
    for model in (
        fit_network(ready, ["a", "b", "c"], "y", hidden=16, max_iter=100, seed=1),
        fit_boosting(ready, ["a", "b", "c"], "y", n_rounds=5),
    ):
        right = model.transform(ready).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
        assert right > best_possible(x, y) - 0.05


def test_threshold_counts_the_cut_itself(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.6, 0.4])], "id int, probability array<double>")
    assert [r["prediction"] for r in with_threshold(df).collect()] == [1.0, 0.0]
    assert [r["prediction"] for r in with_threshold(df, inclusive=False).collect()] == [0.0, 0.0]


def test_candidate_table(spark):
    data = [(c, f, s) for c, scores in enumerate([(0.4, 0.6), (0.9, 0.9), (1.0, 0.8), (0.1, 0.1)]) for f, s in enumerate(scores)]
    table = candidate_results(spark.createDataFrame(data, "candidate bigint, fold int, score double"), ["candidate"], 2)
    assert [r["rank_test_score"] for r in table.orderBy("candidate").collect()] == [3, 1, 1, 4]
    assert best_candidate(table).first()["candidate"] == 1
    third = round_scores(table).where("candidate = 2").first()
    assert third["std_test_score"] == 0.1 and third["split1_test_score"] == 0.8


def test_submission_and_insertion(spark):
    df = spark.createDataFrame([(7, "x", 1.0, [0.2, 0.8])], "id bigint, s string, prediction double, probability array<double>")
    assert rows(submission(df, "id", "y")) == [(7, 1)]
    table = with_prediction(df, "y")
    assert table.columns == ["id", "y", "s"] and rows(table) == [(7, 1, "x")]


def test_lifecycles(train, test):
    names = (COLUMNS, ENCODE, "Survived", "PassengerId")
    grid = {"C": [0.1, 10.0], "max_iter": [100, 200]}
    four = train.unionByName(train.withColumn("PassengerId", F.col("PassengerId") + 50))
    tuned = tune_and_predict(four, test, *names, class_weights={0: 1.0, 1: 1.5}, grid=grid)
    assert [r[0] for r in rows(tuned.submission, "PassengerId")] == [101, 102, 103]
    assert tuned.submission.columns == ["PassengerId", "Survived"]
    assert tuned.search.results.count() == 4
    single = logistic_predict(four, test, *names)
    chances = rows(probabilities(single, "PassengerId", "Survived"), "PassengerId")
    assert all(a + b == pytest.approx(1, abs=0.0011) for _, a, b in chances)
    assert rows(single.submission, "PassengerId") == [(101, 0), (102, 1), (103, 0)]
    forest = forest_predict(four, test, *names, n_trees=20)
    assert forest.submission.count() == 3
    network = network_predict(four, test, ["Age", "Fare", "SibSp", "Parch"], ENCODE, "Survived", "PassengerId", per_frame=True)
    assert network.submission.count() == 3


def test_class_probabilities_round(spark):
    df = spark.createDataFrame([(1, [0.12345, 0.87655])], "id int, probability array<double>")
    assert rows(class_probabilities(df, "id", "y")) == [(1, 0.123, 0.877)]
