"""CSV in and out, with missing-value tokens and doubled quotes."""

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.scalar import date_stamps
from tabprep.operators.frame import LabelledTable, quoted

# Cell texts that mean "missing", and the tags of the methods in file names.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
LOGISTIC_TAG = "logreg"
FOREST_TAG = "rf"
NETWORK_TAG = "torch_neuralnetwork"

_INTEGER = r"^\s*[+-]?\d+\s*$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITE = r"(?i)^\s*[+-]?inf(inity)?\s*$"
# The cell texts that make a boolean column.
_TRUE, _FALSE = ("True", "TRUE", "true"), ("False", "FALSE", "false")


def scan_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """Read CSV files with a header.

    With a schema nothing is read ahead, and a cell that does not fit its type or a
    row with too few or too many cells raises. Without one, a single aggregate over the file decides between bigint,
    double, boolean and string per column; infinities are numbers. Quotes inside quoted cells are doubled.
    ``multi_line`` allows line breaks inside quoted cells, at the price of files that
    cannot be split.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
    )
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if schema is not None:
        text = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])).csv(path)
        types = {f.name: f.dataType for f in schema.fields}
    else:
        text = reader.csv(path)
        types = _guess_types(text)
    cells = _without_tokens(text)
    return cells.select(*[_parsed(n, types[n]).alias(n) for n in cells.columns])


def _parsed(name: str, data_type: T.DataType) -> Column:
    """The cell as its type; one that does not fit raises, in every ANSI mode."""
    cell = quoted(name)
    if isinstance(data_type, T.StringType):
        return cell
    value = cell.try_cast(data_type)
    if isinstance(data_type, T.DoubleType | T.FloatType):
        endless = F.when(F.ltrim(cell).startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
        value = F.when(cell.rlike(_INFINITE), endless.cast(data_type)).otherwise(value)
    elif isinstance(data_type, T.BooleanType):
        value = F.when(cell.isin(*_TRUE), F.lit(True)).when(cell.isin(*_FALSE), F.lit(False)).otherwise(value)
    wrong = F.raise_error(F.concat(F.lit(f"column {name} holds no {data_type.simpleString()}: "), cell))
    return F.when(cell.isNull() | value.isNotNull(), value).otherwise(wrong.cast(data_type))


def _without_tokens(text: DataFrame) -> DataFrame:
    tokens = [F.lit(t) for t in MISSING_TOKENS]
    return text.select(*[F.when(~quoted(n).isin(*tokens), quoted(n)).alias(n) for n in text.columns])


def _guess_types(text: DataFrame) -> dict[str, T.DataType]:
    cells = _without_tokens(text)
    checks = []
    for name in cells.columns:
        present = quoted(name).isNotNull()
        whole = quoted(name).rlike(_INTEGER) & quoted(name).try_cast("bigint").isNotNull()
        number = quoted(name).rlike(_NUMBER) | quoted(name).rlike(_INFINITE)
        checks += [F.count_if(c) for c in (present, whole, number, quoted(name).isin(*_TRUE, *_FALSE))]
    row = list(cells.agg(*[c.alias(f"c{i}") for i, c in enumerate(checks)]).first())
    types: dict[str, T.DataType] = {}
    for i, name in enumerate(cells.columns):
        present, whole, number, truth = row[4 * i : 4 * i + 4]
        if present and whole == present:
            types[name] = T.LongType()
        elif number == present:
            types[name] = T.DoubleType()
        elif truth == present:
            types[name] = T.BooleanType()
        else:
            types[name] = T.StringType()
    return types


def scan_labelled(spark: SparkSession, path: str, label: str, schema=None, multi_line: bool = False) -> LabelledTable:
    table = scan_csv(spark, path, schema, multi_line)
    if label not in table.columns:
        raise ValueError(f"no label column {label}")
    return LabelledTable(table, label)


def submission_path(method: str, moment: dt.datetime, root: str = "output") -> str:
    """``<root>/<day>/submission_<method>_<second>.csv``, stamps on the UTC+9 clock."""
    day, second = date_stamps(moment)
    return f"{root}/{day}/submission_{method}_{second}.csv"


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Write a folder of CSV parts with headers, texts with all their white space; an existing folder raises.

    ``single_file`` brings everything to one task, for small results only.
    """
    table = df.coalesce(1) if single_file else df
    writer = table.write.mode("errorifexists").option("header", True).option("escape", '"')
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def write_one_csv(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> str:
    """Write one CSV file with one header, its rows by ``order_by`` or as the table has them; an existing file raises.

    All tasks write their parts, which are then joined as bytes in their order: by the file system where it can
    join files, else by one stream with a small buffer. No task and no memory holds the whole.
    """
    spark = df.sparkSession
    jvm, configuration = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(configuration)
    if files.exists(target):
        raise FileExistsError(path)
    work = jvm.org.apache.hadoop.fs.Path(f"{path}.parts-{uuid.uuid4().hex}")
    rows = df.orderBy(*[quoted(c) for c in order_by]) if order_by else df
    try:
        plain = {"header": False, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.write.options(**plain).csv(work.toString())
        names = [c if re.fullmatch(r"[^\s\",#][^\",\r\n]*", c) else '"' + c.replace('"', '""') + '"' for c in df.columns]
        parts = sorted(s.getPath().toString() for s in files.listStatus(work) if s.getPath().getName().startswith("part-"))
        whole = jvm.org.apache.hadoop.fs.Path(work, "whole")
        out = files.create(whole)
        try:
            out.write(bytearray((",".join(names) + "\n").encode()))
            if not _joins(files):
                for part in parts:
                    source = files.open(jvm.org.apache.hadoop.fs.Path(part))
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, configuration, False)
                    source.close()
        finally:
            out.close()
        if _joins(files) and parts:
            paths = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
            for i, part in enumerate(parts):
                paths[i] = jvm.org.apache.hadoop.fs.Path(part)
            files.concat(whole, paths)
        if not files.rename(whole, target):
            raise OSError(f"{path} can't be put in place")
    finally:
        files.delete(work, True)
    return path


def _joins(files) -> bool:
    """Whether the file system can join files itself."""
    return files.getScheme() == "hdfs"


def write_submission(
    df: DataFrame, method: str, moment: dt.datetime, root: str = "output", single_file: bool = False, one_file: bool = False
) -> str:
    """Write predictions under their dated name; the caller gives the time, so runs repeat.

    ``one_file`` makes that name a file instead of a folder, see ``write_one_csv``.
    """
    if one_file:
        return write_one_csv(df, submission_path(method, moment, root))
    return write_csv(df, submission_path(method, moment, root), single_file)
