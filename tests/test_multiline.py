import random

import pytest

from tabprep.sources import scan_csv, scan_multiline_csv

SCHEMA = "id int, `a b` string, x double"


def written(path, rows, end="\n"):
    def cell(v):
        text = "" if v is None else str(v)
        return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n\r') else text

    path.write_bytes(end.join([",".join(map(cell, r)) for r in [("id", "a b", "x"), *rows]] + [""]).encode())


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    dice, root = random.Random(2), tmp_path_factory.mktemp("multi")
    for n, (size, end) in enumerate([(400, "\n"), (3, "\n"), (300, "\r\n"), (0, "\n")]):
        rows = []
        for i in range(size):
            # Some cells are longer than a block.
            pieces = [dice.choice(["word", "\n", '"', ",", "é", "\n\n", " ", '"\n"']) for _ in range(dice.choice([1, 4, 30, 900]) if i % 9 == 0 else 3)]
            rows.append((n * 1000 + i, "".join(pieces), dice.choice([0.5, None, -2.0])))
        written(root / f"f{n}.csv", rows, end)
    return str(root)


@pytest.mark.parametrize("size", ["700b", "4k", "128m"])
def test_equals_reading_whole_files(spark, folder, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        found = scan_multiline_csv(spark, folder, SCHEMA)
        got = sorted(map(tuple, found.collect()))
        assert found.schema == scan_csv(spark, folder, SCHEMA, multi_line=True).schema
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = sorted(map(tuple, scan_csv(spark, folder, SCHEMA, multi_line=True).collect()))
    assert len(got) == 703 and got == expected


@pytest.mark.parametrize("text", ["id,a b,x\n1,a\n", "id,a b,x\n1,a,2,3\n", "id,a b,x\n1,a,b\n", "id,other,x\n1,a,2\n", 'id,a b,x\n1,"a,2\n'])
def test_faults_raise(spark, tmp_path, text):
    (tmp_path / "bad.csv").write_text(text)
    with pytest.raises(Exception):
        scan_multiline_csv(spark, str(tmp_path), SCHEMA).collect()


def test_small_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,a b,x\n\n1,"x\n\ny",2')
    assert [tuple(r) for r in scan_multiline_csv(spark, str(tmp_path), SCHEMA).collect()] == [(1, "x\n\ny", 2.0)]
