import datetime as dt

import pytest
from conftest import COLUMNS, ENCODE, FEATURES, rows
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tabprep.errors import ColumnConflictError, SchemaMismatchError
from tabprep.functions import (
    class_weight,
    date_stamps,
    decode,
    is_missing,
    relu,
    round_half_even,
    sigmoid,
    threshold,
)
from tabprep.operators.frame import (
    LabelledTable,
    drop_columns,
    insert_columns,
    missing_mask,
    name_array,
    preview,
    require_same_columns,
    schema_report,
    scores_to_wide,
    select_columns,
    select_numeric,
    shape,
    slice_columns,
)
from tabprep.operators.models import fit_logistic
from tabprep.operators.prepare import fit_preparation
from tabprep.sources import scan_csv, scan_labelled, submission_path, write_csv, write_submission
from tabprep.streaming import score_stream


def write(tmp_path, text, name="t.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_quotes_and_missing_tokens(spark, tmp_path):
    path = write(tmp_path, 'a,b,c\n1,"O\'B, ""Q"" x",NA\n2,,None\n3,z,1.5\n')
    df = scan_csv(spark, path)
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    assert rows(df, "a") == [(1, 'O\'B, "Q" x', None), (2, None, None), (3, "z", 1.5)]
    declared = scan_csv(spark, path, "a int, b string, c double")
    assert dict(declared.dtypes)["a"] == "int" and rows(declared, "a") == rows(df, "a")


def test_csv_types_are_guessed_from_all_rows(spark, tmp_path):
    path = write(tmp_path, "i,d,e,s,n,big\n1,1,1e3,1d,,9\n-2,2.5,.5,x,NaN,99999999999999999999\n+3,NA,7,0x1,,1\n")
    assert dict(scan_csv(spark, path).dtypes) == {
        "i": "bigint", "d": "double", "e": "double", "s": "string", "n": "double", "big": "double",
    }


def test_csv_cells_that_do_not_fit_raise(spark, tmp_path):
    path = write(tmp_path, "a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="column a holds no int: x"):
        scan_csv(spark, path, "a int, b int").collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="column a holds no int: x"):
            scan_csv(spark, path, "a int, b int").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    with pytest.raises(Exception, match="header|MALFORMED|FAILED_READ_FILE"):
        scan_csv(spark, path, "a int, other int").collect()


def test_csv_scan_prunes_columns(spark, tmp_path):
    path = write(tmp_path, "a,b,c\n1,2,3\n")
    plan = scan_csv(spark, path, "a int, b int, c int").select("b")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<b:string>" in plan


def test_labelled_table(spark, tmp_path):
    path = write(tmp_path, "id,y,x\n1,0,a\n2,1,b\n")
    table = scan_labelled(spark, path, "y")
    assert table.features.columns == ["id", "x"]
    assert rows(table.labels("id"), "id") == [(1, 0), (2, 1)]
    assert rows(table.with_label(1 - F.col("y")).labels("id"), "id") == [(1, 1), (2, 0)]
    other = spark.createDataFrame([(1, 7), (3, 8)], "id bigint, y int")
    assert rows(table.with_label_from(other, "id").frame, "id") == [(1, 7, "a"), (2, None, "b")]
    assert rows(table.row_count()) == [(2,)] and rows(shape(table.frame)) == [(2, 3)]
    with pytest.raises(ValueError):
        scan_labelled(spark, path, "z")


def test_submission_file(spark, tmp_path):
    moment = dt.datetime(2024, 1, 31, 20, 0, 5, tzinfo=dt.timezone.utc)
    assert submission_path("rf", moment) == "output/20240201/submission_rf_20240201050005.csv"
    df = spark.createDataFrame([(1, 0), (2, 1)], "id bigint, y int")
    path = write_submission(df, "rf", moment, root=str(tmp_path), single_file=True)
    parts = list((tmp_path / "20240201" / "submission_rf_20240201050005.csv").glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text().splitlines()[0] == "id,y"
    assert rows(scan_csv(spark, path), "id") == [(1, 0), (2, 1)]
    with pytest.raises(AnalysisException):
        write_submission(df, "rf", moment, root=str(tmp_path))
    with pytest.raises(ValueError):
        date_stamps(dt.datetime(2024, 1, 1))


def test_text_survives_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'line\nbreak, "quoted"'), (2, "back\\slash"), (3, "tab\tand 'quote'")], "id bigint, s string")
    path = write_csv(df, str(tmp_path / "out"))
    assert rows(scan_csv(spark, path, df.schema, multi_line=True), "id") == rows(df, "id")


def test_projections(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (2, float("nan"), None)], "a int, b double, c string")
    assert select_columns(df, ["c", "a"]).columns == ["c", "a"]
    assert drop_columns(df, "b").columns == ["a", "c"]
    for bad in (lambda: select_columns(df, ["z"]), lambda: drop_columns(df, "z")):
        with pytest.raises(ValueError):
            bad()
    assert slice_columns(df, 1).columns == ["b", "c"] and slice_columns(df, None, 1).columns == ["a"]
    assert select_numeric(df).columns == ["a", "b"]
    assert rows(missing_mask(df), "a") == [(False, False, False), (False, True, True)]
    assert rows(missing_mask(df, ["a"]), "a") == [(1, False, False), (2, True, True)]
    assert rows(preview(df, "a", 1, 2)) == [(1, 2.0)]
    assert insert_columns(df, 1, {"n": F.lit(1)}).columns == ["a", "n", "b", "c"]
    with pytest.raises(ColumnConflictError):
        insert_columns(df, 1, {"c": F.lit(1)})
    assert insert_columns(df, 1, {"c": F.lit(1)}, on_conflict="keep_base") is df


def test_names_with_dots_and_dashes(spark):
    df = spark.createDataFrame([(1, "1-URGENT")], "`a.b` int, `p-q` string")
    fitted = fit_preparation(df, ["a.b", "p-q"], ["p-q"])
    assert fitted.transform(df).columns == ["a.b", "p-q_1-URGENT"]


def test_table_comparison(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2)], "x int, z int")
    assert rows(schema_report(a, b), "column") == [("x", True, True), ("y", True, False), ("z", False, True)]
    with pytest.raises(SchemaMismatchError, match=r"missing \['y'\], extra \['z'\]"):
        require_same_columns(a, b)
    require_same_columns(a, a)
    with pytest.raises(SchemaMismatchError):
        require_same_columns(a, a.withColumn("x", F.col("x").cast("bigint")))


def test_wide_and_named(spark):
    scores = spark.createDataFrame([("b", 2.0), ("a", 1.0)], "feature string, score double")
    wide = scores_to_wide(scores, ["a", "b"])
    assert wide.columns == ["a", "b"] and rows(wide) == [(1.0, 2.0)]
    df = spark.createDataFrame([(1, [0.1, 0.9])], "id int, p array<double>")
    named = name_array(df, "p", ["y_0", "y_1"])
    assert named.columns == ["id", "y_0", "y_1"] and rows(named) == [(1, 0.1, 0.9)]


def test_scalar_functions(spark):
    df = spark.createDataFrame([(v,) for v in (0.25, 0.35, 0.45, 2.5, 3.5, 0.5)], "v double")
    got = rows(df.select(round_half_even(F.col("v"), 1), round_half_even(F.col("v"), 0)))
    assert [r[0] for r in got[:3]] == [0.2, 0.4, 0.4]
    assert [r[1] for r in got[3:]] == [2.0, 4.0, 0.0]
    one = spark.createDataFrame([(0.0, -2.0, "C", 1, float("nan"))], "a double, b double, c string, y int, n double")
    result = one.select(
        sigmoid(F.col("a")),
        relu(F.col("b")),
        decode(F.col("c"), {"C": "Cherbourg", "S": "Southampton"}),
        decode(F.lit("?"), {"C": "x"}),
        class_weight(F.col("y"), {0: 1.0, 1: 1.5}),
        class_weight(F.col("y"), None),
        threshold(F.lit(0.5)),
        threshold(F.lit(0.5), inclusive=False),
        is_missing(F.col("n"), one.schema["n"].dataType),
    )
    assert rows(result) == [(0.5, 0.0, "Cherbourg", None, 1.5, 1.0, 1, 0, True)]


def test_scoring_a_stream(spark, train, test, tmp_path):
    fitted = fit_preparation(train, COLUMNS, ENCODE)
    model = fit_logistic(fitted.transform(train, ["Survived"]), fitted.feature_names, "Survived", scale=True)
    arriving = str(tmp_path / "in")
    test.write.parquet(arriving)
    rows_in = spark.readStream.schema("PassengerId bigint, " + FEATURES).parquet(arriving)
    out = str(tmp_path / "out")
    query = score_stream(rows_in, fitted, model, "PassengerId", "Survived", out, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    scored = model.transform(fitted.transform(test, ["PassengerId"]))
    expected = rows(scored.select("PassengerId", F.col("prediction").cast("bigint")), "PassengerId")
    assert rows(scan_csv(spark, out), "PassengerId") == expected
