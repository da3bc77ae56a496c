"""Scaling numeric columns with statistics fitted once."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.scalar import nan_to_null
from tabprep.operators.frame import quoted


@dataclass(frozen=True)
class Scaler:
    """(value - shift) / width per column; ``transform`` is one projection.

    A constant column has width 1, so it becomes 0. Values outside the fitted range
    are not clipped.
    """

    shift: dict[str, float]
    width: dict[str, float]

    def scaled(self, name: str, source: Column | None = None) -> Column:
        value = quoted(name) if source is None else source
        return (value.cast("double") - F.lit(self.shift[name])) / F.lit(self.width[name])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(
            *[self.scaled(c).alias(c) if c in self.shift else quoted(c) for c in df.columns]
        )


def _scaler(df: DataFrame, columns, first, second, width) -> Scaler:
    values = [nan_to_null(quoted(c), df.schema[c].dataType).cast("double") for c in columns]
    row = list(df.agg(*[f(v).alias(f"s{i}_{j}") for i, v in enumerate(values) for j, f in enumerate((first, second))]).first())
    shift, widths = {}, {}
    for i, name in enumerate(columns):
        a, b = row[2 * i], row[2 * i + 1]
        if a is None:
            raise ValueError(f"column {name} has no values to fit a scaler on")
        shift[name], widths[name] = a, width(a, b) or 1.0
    return Scaler(shift, widths)


def fit_min_max(df: DataFrame, columns) -> Scaler:
    """Map the fitted minimum to 0 and maximum to 1."""
    return _scaler(df, list(columns), F.min, F.max, lambda low, high: high - low)


def fit_standard(df: DataFrame, columns) -> Scaler:
    """Subtract the mean and divide by the population standard deviation."""
    return _scaler(df, list(columns), F.mean, F.stddev_pop, lambda mean, std: std)
