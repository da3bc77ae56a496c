"""Scalar column functions. All are plain Catalyst expressions."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATING = (T.FloatType, T.DoubleType)


def is_missing(column: Column, data_type: T.DataType) -> Column:
    """NULL, or NaN for floating point columns."""
    if isinstance(data_type, FLOATING):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def nan_to_null(column: Column, data_type: T.DataType) -> Column:
    """The column with NaN turned into NULL, so that aggregates skip it."""
    if isinstance(data_type, FLOATING):
        return F.when(~F.isnan(column), column)
    return column


def numeric_columns(df: DataFrame, columns=None) -> list[str]:
    """Names of the numeric columns, in table order."""
    wanted = set(df.columns if columns is None else columns)
    return [f.name for f in df.schema.fields if f.name in wanted and isinstance(f.dataType, T.NumericType)]


def round_half_even(column: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, ties to even.

    ``F.round`` rounds ties up and ``F.bround`` goes through decimals; scaling and
    ``rint`` is the rule floating point libraries use.
    """
    if digits == 0:
        return F.rint(column)
    scale = F.lit(10.0**digits)
    return F.rint(column * scale) / scale


def indicator(column: Column, value: Column) -> Column:
    """1 where the column equals the value, else 0, also where it is missing."""
    return F.coalesce((column == value).cast("int"), F.lit(0))


def sigmoid(column: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-column))


def relu(column: Column) -> Column:
    return F.greatest(column, F.lit(0.0))


def threshold(score: Column, cut: float = 0.5, inclusive: bool = True) -> Column:
    """1 where the score reaches the cut, else 0."""
    return (score >= cut if inclusive else score > cut).cast("int")


def class_weight(label: Column, weights: dict | None) -> Column:
    """Row weight looked up by class; 1.0 for every class without an entry."""
    column = F.lit(1.0)
    for value, weight in (weights or {}).items():
        column = F.when(label == F.lit(value), F.lit(float(weight))).otherwise(column)
    return column


def decode(column: Column, legend: dict) -> Column:
    """Replace codes by their meaning; a code outside the legend gives NULL."""
    pairs = [F.lit(part) for item in legend.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), column)


def date_stamps(moment: dt.datetime, utc_offset_hours: int = 9) -> tuple[str, str]:
    """(day, second) stamps of a run, on the clock ``utc_offset_hours`` ahead of UTC."""
    if moment.tzinfo is None:
        raise ValueError("the run time needs a time zone")
    local = moment.astimezone(dt.timezone(dt.timedelta(hours=utc_offset_hours)))
    return local.strftime("%Y%m%d"), local.strftime("%Y%m%d%H%M%S")
