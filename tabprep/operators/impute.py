"""Filling missing values with a fitted constant per column."""

from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.functions.scalar import is_missing, nan_to_null, numeric_columns
from tabprep.operators.frame import quoted
from tabprep.operators.ranks import exact_quantiles

METHODS = ("mean", "median", "mode")


def column_means(df: DataFrame, columns=None) -> dict[str, float | None]:
    """Means of the numeric columns, missing values skipped, in one job."""
    names = numeric_columns(df, columns)
    if not names:
        return {}
    row = df.agg(*[F.mean(nan_to_null(quoted(n), df.schema[n].dataType)).alias(n) for n in names]).first()
    return {n: None if row[n] is None else float(row[n]) for n in names}


def column_medians(df: DataFrame, columns=None) -> dict[str, float | None]:
    """Exact medians of the numeric columns."""
    names = numeric_columns(df, columns)
    if not names:
        return {}
    values = {n: nan_to_null(quoted(n), df.schema[n].dataType) for n in names}
    quantiles, _, _ = exact_quantiles(df, values, [0.5], raws={n: quoted(n) for n in names})
    return {n: q[0] for n, q in quantiles.items()}


def column_modes(df: DataFrame, columns=None) -> dict[str, Any]:
    """Most frequent value of each column; of equally frequent ones the smallest.

    Counts are taken before the shuffle and the winner of each column is an aggregate,
    so neither hot nor numerous values gather in one task. Columns of one type share
    a job.
    """
    by_type: dict[str, list[str]] = {}
    for name in columns or df.columns:
        by_type.setdefault(df.schema[name].dataType.simpleString(), []).append(name)
    modes: dict[str, Any] = dict.fromkeys(columns or df.columns)
    for names in by_type.values():
        values = [nan_to_null(quoted(n), df.schema[n].dataType).alias(n) for n in names]
        counted = (
            df.select(*values)
            .unpivot([], [quoted(n) for n in names], "column", "value")
            .where(F.col("value").isNotNull())
            .groupBy("column", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        best = counted.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
        modes.update({row["column"]: row["value"] for row in best.collect()})
    return modes


@dataclass(frozen=True)
class Imputer:
    """Constants that replace missing values; ``transform`` is one projection.

    Integer columns stay integers when every fill is a whole number by construction
    (``keep_integers``), otherwise they become doubles, whatever value was fitted.
    """

    values: dict[str, Any]
    keep_integers: bool = False

    def filled(self, name: str, data_type: T.DataType) -> Column:
        column, value = quoted(name), self.values.get(name)
        if name not in self.values:
            return column
        if isinstance(data_type, T.IntegralType | T.DecimalType) and not self.keep_integers:
            return F.coalesce(column.cast("double"), F.lit(value).cast("double"))
        if value is None:
            return column
        return F.when(is_missing(column, data_type), F.lit(value).cast(data_type)).otherwise(column)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[self.filled(f.name, f.dataType).alias(f.name) for f in df.schema.fields])


def fit_imputer(df: DataFrame, method: str = "mean", digits: int | None = None, columns=None) -> Imputer:
    """Fit fill values on this table.

    Mean and median look at numeric columns only and are rounded half to even at
    ``digits`` places if given; mode looks at every column and keeps its value.
    """
    if method not in METHODS:
        raise ValueError(f"method is one of {METHODS}")
    if method == "mode":
        return Imputer(column_modes(df, columns), keep_integers=True)
    found = column_means(df, columns) if method == "mean" else column_medians(df, columns)
    if digits is not None:
        found = {n: None if v is None else float(np.round(v, digits)) for n, v in found.items()}
    return Imputer(found, keep_integers=digits == 0)
