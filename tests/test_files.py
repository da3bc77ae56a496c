"""Rows by their place in files, and one file of many parts."""

import datetime as dt
import random

import pytest

from tabprep.operators.align import positional_concat, with_file_index
from tabprep.sources.csv import scan_csv, submission_path, write_csv, write_one_csv, write_submission


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """CSV files whose rows have no key, and the rows as they stand there."""
    dice, root, rows = random.Random(5), tmp_path_factory.mktemp("files"), []
    for n, size in enumerate([700, 0, 1, 2500, 40]):
        own = [(dice.choice(["a", "b", "cé", "d" * 40]), dice.randrange(10)) for _ in range(size)]
        (root / f"f{n}.csv").write_text("kind,x\n" + "".join(f"{k},{x}\n" for k, x in own))
        rows += own
    return str(root), rows


@pytest.mark.parametrize("size", ["1k", "7k", "128m"])
def test_rows_keep_their_place(spark, folder, size):
    path, rows = folder
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        found = with_file_index(scan_csv(spark, path, "kind string, x int"))
        assert [tuple(r)[:2] for r in found.orderBy("row_index").collect()] == rows
        assert [r.row_index for r in found.orderBy("row_index").collect()] == list(range(len(rows)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_side_by_side_without_keys(spark, folder, tmp_path):
    path, rows = folder
    other = [(i * 7 % 11,) for i in range(len(rows) + 3)]
    spark.createDataFrame(other, "y int").coalesce(1).write.parquet(str(tmp_path / "y"))
    both = positional_concat(scan_csv(spark, path, "kind string, x int"), spark.read.parquet(str(tmp_path / "y")))
    assert both.columns == ["kind", "x", "y"]
    expected = [(*a, *b) for a, b in zip(rows + [(None, None)] * 3, other)]
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted(map(tuple, both.collect()), key=key) == sorted(expected, key=key)


def test_one_file_of_many_parts(spark, tmp_path):
    rows = [(i, ['plain', 'com,ma', 'quo"te', ' space ', 'é', None, ''][i % 7], i / 3) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, `a \"b\",` string, x double").repartition(9)
    path = write_one_csv(df, str(tmp_path / "out.csv"), order_by=["id"])
    single = write_csv(df.orderBy("id"), str(tmp_path / "single"), single_file=True)
    [part] = [p for p in (tmp_path / "single").iterdir() if p.name.startswith("part-")]
    assert (tmp_path / "out.csv").read_bytes() == part.read_bytes()
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["out.csv", "single"] and single
    with pytest.raises(FileExistsError):
        write_one_csv(df, path)
    write_one_csv(df.limit(0), str(tmp_path / "none.csv"))
    assert (tmp_path / "none.csv").read_text().count("\n") == 1


def test_dated_file(spark, tmp_path):
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.UTC)
    path = write_submission(spark.createDataFrame([(1, 0)], "id int, y int"), "rf", moment, str(tmp_path), one_file=True)
    assert path == submission_path("rf", moment, str(tmp_path)) and open(path).read() == "id,y\n1,0\n"
