"""Profiling: value counts, missing counts, numeric summaries."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.scalar import is_missing, nan_to_null, numeric_columns
from tabprep.operators.frame import missing_mask, preview, quoted, select_columns
from tabprep.operators.ranks import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per distinct value, missing values left out. Unordered: sort to present."""
    data_type = df.schema[column].dataType
    return (
        df.where(~is_missing(quoted(column), data_type))
        .groupBy(quoted(column))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def value_counts_all(df: DataFrame, columns=None, top_k: int | None = None) -> DataFrame:
    """(column, value, n) for every column in one pass; values as text.

    Counts are combined before the shuffle, so a value held by a third of the rows
    sends one row per task. ``top_k`` keeps the most frequent values of each column, of
    equally frequent ones the first as text; each task then passes on no more than those.
    """
    names = list(columns or df.columns)
    text = [nan_to_null(quoted(n), df.schema[n].dataType).cast("string").alias(n) for n in names]
    counted = (
        df.select(*text)
        .unpivot([], [quoted(n) for n in names], "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if top_k is None:
        return counted
    place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    return counted.withColumn("__place", place).where(F.col("__place") <= top_k).drop("__place")


def missing_counts(df: DataFrame, columns=None) -> DataFrame:
    """(column, n_missing) from one aggregate over all columns."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(is_missing(quoted(n), df.schema[n].dataType)).alias(n) for n in names])
    return counted.unpivot([], [quoted(n) for n in names], "column", "n_missing")


def describe(
    df: DataFrame, columns=None, sketch_k: int = 1000, finish_rows: int = 1_000_000, exact: bool = True
) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max) for the numeric columns.

    Sample standard deviation and exact quartiles with linear interpolation. The
    moments ride on a scan the quartiles need anyway. With ``exact=False`` the quartiles are
    values near them and everything takes one scan.
    """
    return _describe(df, columns, sketch_k, finish_rows, with_missing=False, exact=exact)


def _near_quartiles(df, values, moments):
    """The results of ``exact_quantiles`` from one aggregate, with near quartiles."""
    columns = []
    for value in values.values():
        columns += [F.percentile_approx(value, QUARTILES, 10_000), F.count(value), *moments(value)]
    row = list(df.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())
    size = len(columns) // len(values)
    parts = {n: row[i * size : (i + 1) * size] for i, n in enumerate(values)}
    quartiles = {n: p[0] or [None] * len(QUARTILES) for n, p in parts.items()}
    return quartiles, {n: p[1] for n, p in parts.items()}, {n: p[2:] for n, p in parts.items()}


def _describe(df, columns, sketch_k, finish_rows, with_missing, exact=True):
    names = numeric_columns(df, columns)
    values = {n: nan_to_null(quoted(n), df.schema[n].dataType).cast("double") for n in names}
    every = list(df.columns if columns is None else columns) if with_missing else names

    # Missing values of the other columns are counted in the scan that gives the moments.
    others = [n for n in every if n not in names]
    missing = [F.count(F.lit(1)), *[F.count_if(is_missing(quoted(n), df.schema[n].dataType)) for n in others]]
    waiting = list(missing) if with_missing else []

    def moments(column):
        also, waiting[:] = list(waiting), []
        return [F.mean(column), F.stddev_samp(column), F.min(column), F.max(column), *also]

    quartiles, counts, found = (
        _near_quartiles(df, values, moments)
        if names and not exact
        else exact_quantiles(df, values, QUARTILES, moments, sketch_k, finish_rows, {n: quoted(n) for n in names})
        if names
        else ({}, {}, {})
    )
    lacking = {}
    if with_missing:
        counted = found[names[0]][4:] if names else df.agg(*missing).first()
        lacking = {n: counted[0] - c for n, c in counts.items()} | dict(zip(others, counted[1:]))
    rows = []
    for name in every:
        row = (name,)
        if name in quartiles:
            mean, std, low, high = found[name][:4]
            row += (counts[name], mean, std, low, *quartiles[name], high)
        else:
            row += (None,) * 8
        if with_missing:
            row += (lacking[name],)
        rows.append(row)
    schema = "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema + (", n_missing bigint" if with_missing else ""))


def summary(df: DataFrame, columns=None, sketch_k: int = 1000, finish_rows: int = 1_000_000) -> DataFrame:
    """``describe`` and ``missing_counts`` together, one row for every column."""
    return _describe(df, columns, sketch_k, finish_rows, with_missing=True)


@dataclass(frozen=True)
class Profile:
    """Everything there is to see about a table; each part is worked out when asked for."""

    table: DataFrame
    order_by: str | list[str]
    max_rows: int = 1000
    max_columns: int = 100

    @property
    def data(self) -> DataFrame:
        return preview(self.table, self.order_by, self.max_rows, self.max_columns)

    @property
    def statistics(self) -> DataFrame:
        return describe(self.table)

    @property
    def is_missing(self) -> DataFrame:
        return missing_mask(self.table)

    @property
    def missing(self) -> DataFrame:
        return missing_counts(self.table)

    @property
    def values(self) -> DataFrame:
        return value_counts_all(self.table)


def profile(df: DataFrame, order_by, columns=None, max_rows: int = 1000, max_columns: int = 100) -> Profile:
    """Profile a table or some columns of it."""
    return Profile(df if columns is None else select_columns(df, columns), order_by, max_rows, max_columns)
