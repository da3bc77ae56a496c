import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tabprep.operators.profile import (
    describe,
    missing_counts,
    profile,
    summary,
    value_counts,
    value_counts_all,
)
from tabprep.operators.ranks import RankProbe, exact_quantiles, exact_ranks


def frames():
    rng = np.random.default_rng(1)
    n = 4000
    return {
        "even": np.arange(n, dtype=float),
        "normal": rng.normal(size=n),
        "heavy": np.exp(rng.normal(scale=20, size=n)),
        "third": np.where(rng.random(n) < 0.34, 7.0, rng.normal(size=n) * 100),
        "two": (rng.random(n) < 0.5).astype(float),
        "same": np.full(n, 3.5),
    }


@pytest.mark.parametrize("finish_rows,sketch_k", [(1_000_000, 2000), (20, 8), (0, 50)])
def test_quantiles_equal_pandas(spark, finish_rows, sketch_k):
    table = pd.DataFrame(frames())
    table.loc[::7, "normal"] = np.nan
    df = spark.createDataFrame(table).repartition(6)
    values = {c: F.when(~F.isnan(c), F.col(c)) for c in table.columns}
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found, counts, extra = exact_quantiles(
        df, values, ps, lambda v: [F.count(v), F.max(v)], sketch_k=sketch_k, finish_rows=finish_rows
    )
    assert extra["even"] == [4000, 3999.0]
    for name in table.columns:
        expected = [table[name].quantile(p) for p in ps]
        # Neighbours of the heavy column differ a billionfold, so the last bits of a rank show.
        np.testing.assert_allclose(found[name], expected, rtol=1e-9)
        assert counts[name] == table[name].count()


def test_ranks_of_large_integers(spark):
    base = 2**60
    keys = random.Random(3).sample(range(3000), 3000)
    df = spark.createDataFrame([(base + k,) for k in keys], "k bigint").repartition(4)
    probe = RankProbe(F.col("k"), lambda n: [(0,), (1234,), (2999,)])
    hits, totals, _ = exact_ranks(df, [probe], "bigint", finish_rows=5, sketch_k=8)
    assert totals == [3000]
    assert {r: (h.value - base, h.below, h.equal) for r, h in hits[0].items()} == {
        0: (0, 0, 1),
        1234: (1234, 1234, 1),
        2999: (2999, 2999, 1),
    }


def test_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    out = {r["column"]: r for r in describe(df).collect()}
    assert out["a"]["count"] == 0 and out["a"]["p50"] is None
    assert out["b"]["p50"] == 1.5


def test_describe(train):
    expected = {
        "PassengerId": (8, 4.5, 2.4495, 1, 2.75, 4.5, 6.25, 8),
        "Survived": (8, 0.5, 0.5345, 0, 0, 0.5, 1, 1),
        "Pclass": (8, 2.25, 0.8864, 1, 1.75, 2.5, 3, 3),
        "Age": (6, 29.6667, 17.4432, 2, 23.25, 31, 37.25, 54),
        "SibSp": (8, 0.75, 1.0351, 0, 0, 0.5, 1, 3),
        "Parch": (8, 0.625, 0.9161, 0, 0, 0, 1.25, 2),
        "Fare": (8, 29.0312, 25.7281, 7.25, 8.375, 16, 52.25, 71.5),
    }
    got = {r[0]: tuple(round(v, 4) for v in r[1:]) for r in describe(train).collect()}
    assert got == expected


def test_wide_tables_go_in_groups(spark, monkeypatch):
    monkeypatch.setattr("tabprep.operators.ranks._COLUMNS_PER_SCAN", 3)
    df = spark.range(11).selectExpr(*[f"id * {i} as c{i}" for i in range(8)])
    got = {r["column"]: (r["p50"], r["max"], r["mean"]) for r in describe(df).collect()}
    assert got == {f"c{i}": (5.0 * i, 10.0 * i, 5.0 * i) for i in range(8)}


def test_summary_has_every_column(train):
    got = {r["column"]: (r["count"], r["n_missing"]) for r in summary(train).collect()}
    assert got["Age"] == (6, 2) and got["Embarked"] == (None, 1) and got["Sex"] == (None, 0)
    assert list(got) == train.columns
    only_text = summary(train, ["Sex", "Embarked"]).collect()
    assert [r["n_missing"] for r in only_text] == [0, 1]


def test_counts(train):
    assert rows(value_counts(train, "Pclass"), "Pclass") == [(1, 2), (2, 2), (3, 4)]
    assert rows(value_counts(train, "Embarked"), "Embarked") == [("C", 2), ("Q", 1), ("S", 4)]
    missing = dict(rows(missing_counts(train)))
    assert missing == {c: {"Age": 2, "Embarked": 1}.get(c, 0) for c in train.columns}
    totals = value_counts_all(train).groupBy("column").agg(F.sum("n").alias("n")).collect()
    assert {r["column"]: r["n"] + missing[r["column"]] for r in totals} == dict.fromkeys(train.columns, 8)


def test_profile(train):
    found = profile(train, "PassengerId", ["PassengerId", "Age", "Sex"], max_rows=3, max_columns=2)
    assert rows(found.data) == [(1, 22.0), (2, 38.0), (3, None)]
    assert found.is_missing.columns == ["PassengerId", "Age", "Sex"]
    assert rows(found.is_missing.agg(F.count_if("Age"))) == [(2,)]
    assert {r["column"] for r in found.statistics.collect()} == {"PassengerId", "Age"}
    assert found.values.count() == 8 + 6 + 2
    assert rows(found.missing.where("n_missing > 0")) == [("Age", 2)]
