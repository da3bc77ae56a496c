"""One-hot encoding with a vocabulary fitted once."""

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.errors import CardinalityError, ColumnConflictError
from tabprep.functions.scalar import indicator, is_missing, nan_to_null
from tabprep.operators.frame import quoted

MISSING_RULES = ("zeros", "category")


def fit_vocabulary(df: DataFrame, columns, max_categories: int = 1000) -> tuple[dict[str, list], set[str]]:
    """Sorted distinct values of each column, and the columns that have missing values.

    Distinct (column, value) pairs are found by one distributed aggregate. A column
    beyond ``max_categories`` raises; no more than the allowed number of pairs ever
    reaches the driver.
    """
    names = list(columns)
    types = {n: df.schema[n].dataType for n in names}
    text = [nan_to_null(quoted(n), types[n]).cast("string").alias(n) for n in names]
    pairs = df.select(*text).unpivot([], [quoted(n) for n in names], "column", "value").distinct()
    room = (max_categories + 1) * len(names)
    found = pairs.limit(room + 1).collect()
    vocabulary: dict[str, list] = {n: [] for n in names}
    with_missing = set()
    for name, value in found:
        if value is None:
            with_missing.add(name)
        else:
            vocabulary[name].append(value)
    crowded = [n for n in names if len(vocabulary[n]) > max_categories]
    if crowded or len(found) > room:
        raise CardinalityError(f"more than {max_categories} categories in {crowded or 'a column of ' + str(names)}")
    return {n: sorted(vocabulary[n], key=_sort_key(types[n])) for n in names}, with_missing


def _sort_key(data_type: T.DataType):
    if isinstance(data_type, T.IntegralType):
        return int
    if isinstance(data_type, T.NumericType):
        return float
    return str


@dataclass(frozen=True)
class OneHotEncoder:
    """Fitted categories per column; ``transform`` is one projection.

    The indicator columns ``<column>_<value>`` take the place of their source. A
    value without a category gives all zeros. A missing value gives all zeros too,
    or its own last indicator ``<column>_nan`` where the fit table had one and the
    rule is ``category``.
    """

    vocabulary: dict[str, list[str]]
    missing_category: frozenset[str] = frozenset()

    def names(self, column: str) -> list[str]:
        names = [f"{column}_{value}" for value in self.vocabulary[column]]
        return names + ([f"{column}_nan"] if column in self.missing_category else [])

    def indicators(self, column: str, data_type: T.DataType, source: Column | None = None) -> list[Column]:
        value = quoted(column) if source is None else source
        columns = [indicator(value, F.lit(v).cast(data_type)) for v in self.vocabulary[column]]
        if column in self.missing_category:
            columns.append(is_missing(value, data_type).cast("int"))
        return [c.alias(n) for c, n in zip(columns, self.names(column))]

    def output_names(self, columns) -> list[str]:
        """Names after encoding a table with these columns; a clash raises."""
        names: list[str] = []
        for column in columns:
            names += self.names(column) if column in self.vocabulary else [column]
        if len(set(names)) < len(names):
            clash: Any = sorted({n for n in names if names.count(n) > 1})
            raise ColumnConflictError(f"encoding gives columns {clash} twice")
        return names

    def transform(self, df: DataFrame) -> DataFrame:
        self.output_names(df.columns)
        columns: list[Column] = []
        for field in df.schema.fields:
            if field.name in self.vocabulary:
                columns += self.indicators(field.name, field.dataType)
            else:
                columns.append(quoted(field.name))
        return df.select(*columns)


def fit_one_hot(df: DataFrame, columns, missing: str = "zeros", max_categories: int = 1000) -> OneHotEncoder:
    if missing not in MISSING_RULES:
        raise ValueError(f"missing is one of {MISSING_RULES}")
    vocabulary, with_missing = fit_vocabulary(df, columns, max_categories)
    return OneHotEncoder(vocabulary, frozenset(with_missing if missing == "category" else ()))
