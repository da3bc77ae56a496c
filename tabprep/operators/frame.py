"""Projections over one table: choosing, dropping, inserting and comparing columns."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.errors import ColumnConflictError, SchemaMismatchError
from tabprep.functions.scalar import is_missing, numeric_columns


def _require(df: DataFrame, columns) -> None:
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")


def quoted(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or dashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(name: str, *tables: DataFrame) -> str:
    """``name``, with underscores before it until no column of the tables begins with it."""
    taken = [c.lower() for df in tables for c in df.columns]
    while any(c.startswith(name) for c in taken):
        name = f"_{name}"
    return name


def select_columns(df: DataFrame, columns) -> DataFrame:
    """The named columns in the given order; an unknown name raises."""
    _require(df, columns)
    return df.select(*[quoted(c) for c in columns])


def drop_columns(df: DataFrame, *columns) -> DataFrame:
    """The table without the named columns; an unknown name raises."""
    _require(df, columns)
    return df.drop(*columns)


def slice_columns(df: DataFrame, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Columns by position."""
    return df.select(*[quoted(c) for c in df.columns[start:stop]])


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c) for c in numeric_columns(df)])


@dataclass(frozen=True)
class LabelledTable:
    """One table that knows which of its columns is the label.

    Features and label stay together in one DataFrame: rows have no position in
    Spark, so a separate label vector would need a join to come back.
    """

    frame: DataFrame
    label: str

    @property
    def features(self) -> DataFrame:
        return drop_columns(self.frame, self.label)

    def labels(self, *keys: str) -> DataFrame:
        return select_columns(self.frame, [*keys, self.label])

    def with_label(self, label: Column) -> "LabelledTable":
        """Replace the label by an expression over the same rows."""
        return LabelledTable(self.frame.withColumn(self.label, label), self.label)

    def with_label_from(self, other: DataFrame, key: str) -> "LabelledTable":
        """Replace the label by the one another table holds under the same key, NULL if none.

        A key that the other table repeats raises when it is met: which label counts is unknown.
        """
        columns = self.frame.columns
        joined = self.features.join(one_per_key(select_columns(other, [key, self.label]), key), key, "left")
        return LabelledTable(select_columns(joined, columns), self.label)

    def row_count(self) -> DataFrame:
        return row_count(self.frame)


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """The table with each key once; a key on several rows raises as soon as it is read.

    Rows of a key are counted and combined before the shuffle, which a join by that key needs anyway.
    """
    others = [c for c in df.columns if c != key]
    firsts = [F.first(quoted(c)).alias(c) for c in others]
    grouped = df.groupBy(quoted(key)).agg(*firsts, F.count(F.lit(1)).alias("__n"))
    wrong = F.raise_error(F.concat(F.lit(f"key {key} repeats: "), quoted(key).cast("string")))

    def checked(name: str) -> Column:
        return F.when(F.col("__n") == 1, quoted(name)).otherwise(wrong.cast(df.schema[name].dataType)).alias(name)

    # Checked in every column, so that no unused one takes the check away.
    return grouped.select(*[quoted(c) if c == key else checked(c) for c in df.columns])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def insert_columns(df: DataFrame, position: int, columns: dict[str, Column], on_conflict: str = "raise") -> DataFrame:
    """Put derived columns into the table at a position.

    ``on_conflict='keep_base'`` returns the table unchanged when a name is taken.
    """
    if on_conflict not in ("raise", "keep_base"):
        raise ValueError("on_conflict is 'raise' or 'keep_base'")
    taken = sorted(set(columns).intersection(df.columns))
    if taken:
        if on_conflict == "keep_base":
            return df
        raise ColumnConflictError(f"columns exist already: {taken}")
    left, right = df.columns[:position], df.columns[position:]
    return df.select(
        *[quoted(c) for c in left],
        *[column.alias(name) for name, column in columns.items()],
        *[quoted(c) for c in right],
    )


def missing_mask(df: DataFrame, keys=()) -> DataFrame:
    """The table with every value replaced by whether it is missing; keys stay as they are."""
    return df.select(
        *[
            quoted(f.name) if f.name in keys else is_missing(quoted(f.name), f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def preview(df: DataFrame, order_by, max_rows: int = 1000, max_columns: int = 100) -> DataFrame:
    """The first rows in key order and the first columns; the order makes it repeatable."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[quoted(k) for k in keys]).limit(max_rows).select(*[quoted(c) for c in df.columns[:max_columns]])


def scores_to_wide(scores: DataFrame, names, name: str = "feature", value: str = "score") -> DataFrame:
    """Turn (feature, score) rows into one row with a column per feature.

    Features that ``names`` leaves out raise.
    """
    names = list(names)
    stray = F.count_if(~quoted(name).isin(names) | quoted(name).isNull())
    columns = [F.max(F.when(quoted(name) == F.lit(n), quoted(value))).alias(n) for n in names]
    wide = scores.agg(*columns, stray.alias("__stray"))
    wrong = F.raise_error(F.lit("there are scores of features without a column"))
    checked = [F.when(F.col("__stray") == 0, quoted(n)).otherwise(wrong.cast(wide.schema[n].dataType)).alias(n) for n in names]
    return wide.select(*checked)


def name_array(df: DataFrame, array: str, names) -> DataFrame:
    """Give the elements of an array column names and drop the array."""
    kept = [quoted(c) for c in df.columns if c != array]
    return df.select(*kept, *[quoted(array)[i].alias(n) for i, n in enumerate(names)])


def schema_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """(column, in_left, in_right) for every column of either table."""
    names = list(dict.fromkeys([*left.columns, *right.columns]))
    rows = [(n, n in left.columns, n in right.columns) for n in names]
    return left.sparkSession.createDataFrame(rows, "column string, in_left boolean, in_right boolean")


def require_same_columns(left: DataFrame, right: DataFrame, check_types: bool = True) -> None:
    """Raise unless both tables have the same columns in the same order."""
    if left.columns != right.columns:
        missing = [c for c in left.columns if c not in right.columns]
        extra = [c for c in right.columns if c not in left.columns]
        raise SchemaMismatchError(missing, extra)
    if check_types:
        differing = [a.name for a, b in zip(left.schema.fields, right.schema.fields) if a.dataType != b.dataType]
        if differing:
            raise SchemaMismatchError(differing, differing)
