"""Properties that need no expected values, on the star-schema tables."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

import tabprep.operators.newton as newton
from tabprep.operators.encode import fit_one_hot
from tabprep.operators.folds import stratified_folds
from tabprep.operators.impute import column_modes, fit_imputer
from tabprep.operators.profile import describe, missing_counts, value_counts_all
from tabprep.operators.scale import fit_min_max, fit_standard
from tabprep.operators.tune import grid_search
from tabprep.plans.queries import events_with_unknowns, lineitem_with_unknowns, orders_with_unknowns


def test_indicators_of_a_row_add_up_to_one_unless_missing(spark, sf):
    table = orders_with_unknowns(spark, sf).select("o_orderstatus", "o_orderpriority")
    for rule in ("zeros", "category"):
        encoder = fit_one_hot(table, ["o_orderpriority"], missing=rule)
        total = sum(F.col(f"`{n}`") for n in encoder.names("o_orderpriority"))
        encoded = encoder.transform(table.withColumn("known", F.col("o_orderpriority").isNotNull()))
        expected = F.col("known").cast("int") if rule == "zeros" else F.lit(1)
        assert encoded.where(total != expected).count() == 0


def test_nothing_is_missing_after_filling(spark, sf):
    table = lineitem_with_unknowns(spark, sf)
    for method in ("mean", "median", "mode"):
        filled = fit_imputer(table, method, 1).transform(table)
        assert {r["n_missing"] for r in missing_counts(filled).collect()} == {0}
        kept = table.agg(F.sum("l_extendedprice"), F.count("l_extendedprice"))
        known = filled.join(table.select("l_orderkey", "l_linenumber").distinct(), ["l_orderkey", "l_linenumber"])
        assert known.count() == table.count() and rows(kept)[0][1] < table.count()


def test_scaled_columns_have_their_ranges(spark, sf):
    table = lineitem_with_unknowns(spark, sf).select("l_quantity", "l_extendedprice")
    low_high = fit_min_max(table, table.columns).transform(table)
    assert rows(low_high.agg(*[f(c) for c in table.columns for f in (F.min, F.max)])) == [(0.0, 1.0, 0.0, 1.0)]
    standard = fit_standard(table, table.columns).transform(table)
    found = rows(standard.agg(*[f(c) for c in table.columns for f in (F.mean, F.stddev_pop)]))[0]
    assert found == pytest.approx((0, 1, 0, 1), abs=1e-9)


def test_counts_and_missing_make_all_rows(spark, sf):
    table = events_with_unknowns(spark, sf)
    counted = dict(rows(value_counts_all(table).groupBy("column").agg(F.sum("n"))))
    missing = dict(rows(missing_counts(table)))
    assert {c: counted[c] + missing[c] for c in table.columns} == dict.fromkeys(table.columns, table.count())


def test_folds_split_each_class_evenly(spark, sf):
    table = orders_with_unknowns(spark, sf).select("o_orderkey", "o_custkey").withColumn("y", F.col("o_custkey") % 3)
    sizes = stratified_folds(table, "y", "o_orderkey", 7).groupBy("y", "fold").count()
    spread = sizes.groupBy("y").agg(F.count("*"), F.max("count") - F.min("count")).collect()
    assert len(spread) == 3 and all(r[1] == 7 and r[2] <= 1 for r in spread)


def test_layout_of_the_input_changes_nothing(spark, sf):
    table = lineitem_with_unknowns(spark, sf)
    other = table.repartition(13, "l_quantity")
    names = ["l_quantity", "l_extendedprice", "l_tax"]
    a, b = (rows(describe(t, names).select("column", "count", "min", "p25", "p50", "p75", "max"), "column") for t in (table, other))
    assert a == b
    assert column_modes(table, names) == column_modes(other, names)


def test_a_third_of_the_rows_on_one_value(spark):
    df = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS v", "cast(id % 3 = 0 as int) AS y")
    assert column_modes(df, ["v"]) == {"v": 5}
    got = {r["column"]: r["p25"] for r in describe(df, ["v"], finish_rows=100).collect()}
    assert got["v"] == df.selectExpr("percentile(v, 0.25)").first()[0]
    sizes = dict(rows(stratified_folds(df, "y", "id").where("y = 1").groupBy("fold").count()))
    assert set(sizes.values()) == {2000}


def test_a_whole_grid_takes_few_scans(spark, monkeypatch):
    scans = []
    real = newton.RowBlocks._advance
    monkeypatch.setattr(newton.RowBlocks, "_advance", lambda self, *a: scans.append(1) or real(self, *a))
    df = spark.range(500).selectExpr("id", "cast(id * 37 % 101 as double) AS a", "cast(id * 37 % 101 + id % 30 > 60 as int) AS y")
    found = grid_search(df, ["a"], "y", "id")
    assert found.results.count() == 70 and len(scans) <= 25
