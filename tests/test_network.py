import numpy as np
import pytest
from pyspark.sql import functions as F

from tabprep.operators.network import _functions, fit_relu_network


@pytest.fixture(scope="module")
def rings(spark):
    """Class 1 inside a circle, which no linear model can tell."""
    dice = np.random.default_rng(4)
    x = dice.uniform(-1, 1, (1500, 2))
    y = (np.hypot(*x.T) < 0.75).astype(int)
    return spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id bigint, `a.x` double, p double, y int")


def test_gradient_equals_finite_differences():
    dice = np.random.default_rng(1)
    output, gradient = _functions(3, 5)
    point, x, y = dice.normal(size=3 * 5 + 11), dice.normal(size=(7, 3)), dice.integers(0, 2, 7).astype(float)
    loss, found = gradient(point, x, y)
    for i in range(len(point)):
        step = np.zeros(len(point))
        step[i] = 1e-6
        assert found[i] == pytest.approx((gradient(point + step, x, y)[0] - gradient(point - step, x, y)[0]) / 2e-6, abs=1e-6)
    z = output(point, x)[0]
    assert loss == pytest.approx(np.mean(np.log(1 + np.exp(-np.where(y > 0, z, -z)))))


def test_learns_what_is_not_linear(rings):
    model = fit_relu_network(rings, ["a.x", "p"], "y", "id", epochs=60, rate=0.01)
    scored = model.transform(rings)
    assert scored.columns == [*rings.columns, "probability", "prediction"]
    right = scored.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert right > 0.96
    assert scored.where("abs(probability[0] + probability[1] - 1) > 1e-12").count() == 0


@pytest.mark.parametrize("shard_rows", [1 << 16, 200])
def test_layout_changes_nothing(rings, shard_rows):
    points = [fit_relu_network(rings.repartition(n), ["a.x", "p"], "y", "id", hidden=8, epochs=3, shard_rows=shard_rows).point for n in (1, 2, 8)]
    assert np.allclose(points[0], points[1], rtol=1e-9) and np.allclose(points[0], points[2], rtol=1e-9)


def test_one_shard_is_sequential_adam(spark):
    """One batch of all rows each epoch, whose order then doesn't count."""
    dice = np.random.default_rng(2)
    x, y = dice.normal(size=(50, 2)), dice.integers(0, 2, 50).astype(float)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id int, a double, b double, y double")
    model = fit_relu_network(df, ["a", "b"], "y", "id", hidden=4, epochs=5, batch_size=64, rate=0.01, seed=3)
    _, gradient = _functions(2, 4)
    w = fit_relu_network(df, ["a", "b"], "y", "id", hidden=4, epochs=0, seed=3).point
    m, v = np.zeros(len(w)), np.zeros(len(w))
    for t in range(1, 6):
        g = gradient(w, x, y)[1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        w = w - 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    assert np.allclose(model.point, w, rtol=1e-9)


def test_faults(spark, rings):
    with pytest.raises(ValueError):
        fit_relu_network(rings.limit(0), ["p"], "y", "id")
    for bad in (rings.withColumn("y", F.lit(2)), rings.withColumn("p", F.lit(None).cast("double"))):
        with pytest.raises(Exception, match="must"):
            fit_relu_network(bad, ["p"], "y", "id", epochs=1)
    # Rows of one key, very many of them.
    same = rings.withColumn("id", F.lit(1))
    assert fit_relu_network(same, ["a.x", "p"], "y", "id", hidden=4, epochs=1, shard_rows=100).point.shape == (17,)
    assert fit_relu_network(rings, ["p"], "y", "id", hidden=2, epochs=1).transform(rings.limit(0)).count() == 0
