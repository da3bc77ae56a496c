"""Whole preparations: from a raw table to model-ready columns."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.scalar import nan_to_null, numeric_columns
from tabprep.operators.encode import OneHotEncoder, fit_one_hot
from tabprep.operators.frame import quoted, require_same_columns, select_columns
from tabprep.operators.impute import Imputer, fit_imputer
from tabprep.operators.scale import Scaler, fit_standard


@dataclass(frozen=True)
class Preparation:
    """Select, one-hot encode, fill: fitted once, applied as a single projection.

    Columns named in ``keys`` at transform time (ids, the label) pass through in
    front, so rows never have to be matched up again afterwards.
    """

    columns: list[str]
    encoder: OneHotEncoder
    imputer: Imputer

    @property
    def feature_names(self) -> list[str]:
        return self.encoder.output_names(self.columns)

    def transform(self, df: DataFrame, keys=()) -> DataFrame:
        selected = select_columns(df, [*keys, *self.columns])
        columns = [quoted(k) for k in keys]
        self.feature_names  # a clash of names raises here
        for name in self.columns:
            data_type = selected.schema[name].dataType
            if name in self.encoder.vocabulary:
                columns += self.encoder.indicators(name, data_type)
            else:
                columns.append(self.imputer.filled(name, data_type).alias(name))
        return selected.select(*columns)


def fit_preparation(
    df: DataFrame,
    columns,
    encode,
    method: str = "mean",
    digits: int | None = 1,
    max_categories: int = 1000,
) -> Preparation:
    """Fit on a table: one job for the vocabularies, one for the fill values."""
    columns, encode = list(columns), list(encode)
    stray = [c for c in encode if c not in columns]
    if stray:
        raise ValueError(f"columns to encode are not selected: {stray}")
    selected = select_columns(df, columns)
    others = [c for c in columns if c not in encode]
    return Preparation(
        columns,
        fit_one_hot(selected, encode, "zeros", max_categories),
        fit_imputer(selected, method, digits, others),
    )


def prepare_pair(
    train: DataFrame,
    test: DataFrame,
    columns,
    encode,
    digits: int | None = 1,
    per_frame: bool = False,
    keys=((), ()),
    method: str = "mean",
    max_categories: int = 1000,
) -> tuple[DataFrame, DataFrame]:
    """Prepare a train and a test table.

    By default both use what the train table taught. ``per_frame=True`` fits each on
    itself, which may give the two tables different columns or types; that raises.
    """
    fitted = fit_preparation(train, columns, encode, method, digits, max_categories)
    other = fit_preparation(test, columns, encode, method, digits, max_categories) if per_frame else fitted
    prepared = fitted.transform(train, keys[0]), other.transform(test, keys[1])
    require_same_columns(
        prepared[0].select(*[quoted(c) for c in fitted.feature_names]),
        prepared[1].select(*[quoted(c) for c in other.feature_names]),
    )
    return prepared


@dataclass(frozen=True)
class ColumnTransformer:
    """Fill, then standardised numeric columns followed by one-hot columns.

    Everything else is dropped, except the ``keys`` named at transform time. The
    fill values belong to the table they were fitted on, see ``fill_with``.
    """

    numeric: list[str]
    encoder: OneHotEncoder
    imputer: Imputer
    scaler: Scaler

    @property
    def feature_names(self) -> list[str]:
        return self.encoder.output_names([*self.numeric, *self.encoder.vocabulary])

    def transform(self, df: DataFrame, keys=(), fill_with: Imputer | None = None) -> DataFrame:
        imputer = fill_with or self.imputer
        used = [*self.numeric, *self.encoder.vocabulary]
        types = {f.name: f.dataType for f in select_columns(df, [*keys, *used]).schema.fields}
        columns = [quoted(k) for k in keys]
        for name in self.numeric:
            columns.append(self.scaler.scaled(name, imputer.filled(name, types[name])).alias(name))
        for name in self.encoder.vocabulary:
            filled = imputer.filled(name, types[name])
            columns += self.encoder.indicators(name, types[name], filled)
        return df.select(*columns)


def fit_column_transformer(
    df: DataFrame, numeric, categorical, digits: int | None = 0, missing: str = "category", max_categories: int = 1000, method: str = "mean"
) -> ColumnTransformer:
    """Fit fill values by ``method``, then scaler and vocabularies on the filled table."""
    numeric, categorical = list(numeric), list(categorical)
    selected = select_columns(df, [*numeric, *categorical])
    # Numeric codes used as categories are filled like every numeric column.
    if method == "mean" and set(numeric) <= set(numeric_columns(selected)):
        imputer, scaler = _mean_fill_and_scale(selected, numeric, digits)
        filled = imputer.transform(selected)
    else:
        imputer = fit_imputer(selected, method, digits)
        filled = imputer.transform(selected)
        scaler = fit_standard(filled, numeric)
    return ColumnTransformer(numeric, fit_one_hot(filled, categorical, missing, max_categories), imputer, scaler)


def _mean_fill_and_scale(df: DataFrame, numeric: list[str], digits: int | None) -> tuple[Imputer, Scaler]:
    """Mean fill and the standard scale of the filled columns, in one scan: moments with a fill follow from those without."""
    filling = numeric_columns(df)
    sums = []
    for i, name in enumerate(filling):
        value = nan_to_null(quoted(name), df.schema[name].dataType)
        sums += [f(value).alias(f"s{i}_{j}") for j, f in enumerate((F.mean, F.var_pop, F.count, F.min, F.max))]
    row = list(df.agg(F.count(F.lit(1)).alias("n"), *sums).first())
    found = {name: row[1 + 5 * i : 6 + 5 * i] for i, name in enumerate(filling)}
    fills = {n: None if v[0] is None else float(v[0] if digits is None else np.round(float(v[0]), digits)) for n, v in found.items()}
    shift, width = {}, {}
    for name in numeric:
        mean, variance, n, low, high = found[name]
        if mean is None:
            raise ValueError(f"column {name} has no values to fit a scaler on")
        mean, fill, gone = float(mean), fills[name], row[0] - n
        shift[name] = mean + (fill - mean) * (gone / row[0])
        spread = (n * (variance + (mean - shift[name]) ** 2) + gone * (fill - shift[name]) ** 2) / row[0]
        # A constant column, whose filled moments may differ in the last digit.
        width[name] = 1.0 if low == high and (not gone or fill == low) else float(np.sqrt(spread)) or 1.0
    return Imputer(fills, keep_integers=digits == 0), Scaler(shift, width)
