"""Stratified folds and parameter grids for tuning."""

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.errors import CardinalityError, KeyColumnError
from tabprep.operators.align import with_row_index
from tabprep.operators.frame import quoted, unused
from tabprep.operators.ranks import RankProbe, exact_ranks


def log_spaced(low: float, high: float, n: int) -> list[float]:
    """``n`` powers of ten with exponents from ``low`` to ``high``."""
    return [float(v) for v in np.logspace(low, high, n)]


def evenly_spaced(low: float, high: float, n: int) -> list[int]:
    return [int(v) for v in np.linspace(low, high, n)]


def parameter_grid(parameters: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    """Every combination, the first parameter varying slowest."""
    return [dict(zip(parameters, values)) for values in itertools.product(*parameters.values())]


def with_candidates(df: DataFrame, candidates: Sequence[dict[str, Any]], name: str = "candidate") -> DataFrame:
    """Each row once per candidate, for small tables such as one row per fold."""
    options = F.array(
        *[
            F.struct(F.lit(i).cast("bigint").alias(name), *[F.lit(v).alias(k) for k, v in c.items()])
            for i, c in enumerate(candidates)
        ]
    )
    return df.select("*", F.inline(options))


def fold_sizes(class_sizes: Sequence[int], n_folds: int) -> list[list[int]]:
    """Rows of each class in each fold, classes in order of first appearance.

    Lay the rows out sorted by class and deal them to the folds in turn; a fold gets
    from a class as many rows as it was dealt.
    """
    sizes, start = [], 0
    for n in class_sizes:
        sizes.append([(start + n - f + n_folds - 1) // n_folds - (start - f + n_folds - 1) // n_folds for f in range(n_folds)])
        start += n
    return sizes


@dataclass(frozen=True)
class StratifiedFolds:
    """Key values at which the next fold begins, per class.

    A class's rows in key order fall into the folds as consecutive blocks, so the
    fold of a row is a comparison of its key with a few constants: no sort, no
    shuffle, no join.
    """

    label: str
    key: str
    cuts: dict[Any, list]
    n_folds: int

    def fold(self) -> Column:
        column = F.lit(None).cast("int")
        for value, cuts in self.cuts.items():
            passed = F.lit(0)
            for cut in cuts:
                if cut is None:
                    continue
                passed = passed + (quoted(self.key) >= F.lit(cut)).cast("int")
            # Folds that get no row of this class share a cut with the next one.
            column = F.when(quoted(self.label) == F.lit(value), passed).otherwise(column)
        return column

    def transform(self, df: DataFrame, name: str = "fold") -> DataFrame:
        return df.withColumn(name, self.fold())


# Each class adds a few tests per row to the search for cuts; beyond this many the rows
# are numbered instead. Both give the same folds and refuse the same keys.
_CLASSES_TO_CUT = 20


def require_unique_key(df: DataFrame, key: str) -> None:
    """Raise if a key is on several rows. Shuffles the keys alone, each once per task."""
    repeated = df.groupBy(quoted(key)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise KeyColumnError(f"key {key} has missing or repeated values")


def _classes(df: DataFrame, label: str, key: str, max_classes: int) -> list:
    """(label, rows, smallest key) of the classes, in order of first appearance."""
    found = (
        df.groupBy(quoted(label).alias("label"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(quoted(key)).alias("first"),
            F.count_if(quoted(key).isNull()).alias("no_key"),
        )
        .limit(max_classes + 1)
        .collect()
    )
    if len(found) > max_classes:
        raise CardinalityError(f"more than {max_classes} classes in {label}")
    if any(row["label"] is None for row in found):
        raise ValueError(f"label {label} has missing values")
    if any(row["no_key"] for row in found):
        raise KeyColumnError(f"key {key} has missing values")
    return sorted(found, key=lambda row: row["first"])


def stratified_folds(
    df: DataFrame,
    label: str,
    key: str,
    n_folds: int = 5,
    name: str = "fold",
    max_classes: int = 10_000,
    finish_rows: int = 1_000_000,
) -> DataFrame:
    """Add the fold of each row: unshuffled stratified k-fold in key order.

    Missing or repeated keys raise, which takes a shuffle of the keys. Beyond that, numeric keys and
    few classes need none; otherwise the rows are numbered in
    key order first. More than ``max_classes`` classes raise.
    """
    classes = _classes(df, label, key, max_classes)
    require_unique_key(df, key)
    numeric = isinstance(df.schema[key].dataType, T.IntegralType | T.DoubleType | T.FloatType)
    if numeric and len(classes) <= _CLASSES_TO_CUT:
        return _cuts(df, label, key, classes, n_folds, finish_rows).transform(df, name)
    return _folds_by_index(df, label, key, classes, n_folds, name)


def fit_stratified_folds(
    df: DataFrame, label: str, key: str, n_folds: int = 5, finish_rows: int = 1_000_000, max_classes: int = 1000
) -> StratifiedFolds:
    """Find where each class's folds begin, as exact order statistics of a numeric key.

    Each class makes the search and the fitted expression longer; more than ``max_classes`` raise.
    """
    require_unique_key(df, key)
    return _cuts(df, label, key, _classes(df, label, key, max_classes), n_folds, finish_rows)


def _starts(classes: list, n_folds: int) -> list[list[int]]:
    """Per class, the position within the class at which folds 1, 2, … begin."""
    blocks = fold_sizes([row["n"] for row in classes], n_folds)
    return [[int(s) for s in np.cumsum(sizes)[:-1]] for sizes in blocks]


def _cuts(df, label, key, classes, n_folds, finish_rows) -> StratifiedFolds:
    starts = _starts(classes, n_folds)
    kind = "bigint" if isinstance(df.schema[key].dataType, T.IntegralType) else "double"
    probes = [
        RankProbe(
            F.when(quoted(label) == F.lit(row["label"]), quoted(key)),
            lambda n, ranks=begin: [(r,) for r in sorted(set(ranks)) if r < n],
            row["n"],
            quoted(key),
        )
        for row, begin in zip(classes, starts)
    ]
    hits, _, _ = exact_ranks(df, probes, kind, finish_rows=finish_rows)
    cuts = {}
    for row, begin, found in zip(classes, starts, hits):
        if any(found[r].below != r for r in begin if r in found):
            raise KeyColumnError(f"key {key} repeats where folds meet")
        cuts[row["label"]] = [found[r].value if r in found else None for r in begin]
    return StratifiedFolds(label, key, cuts, n_folds)


def _folds_by_index(df, label, key, classes, n_folds, name) -> DataFrame:
    """The same folds from the rows' positions in (label, key) order."""
    starts = dict(zip([row["label"] for row in classes], _starts(classes, n_folds)))
    lookup, position = [], 0
    for row in sorted(classes, key=lambda row: row["label"]):
        lookup.append((row["label"], [position + s for s in starts[row["label"]]]))
        position += row["n"]
    own, cut_names, row = unused("__label", df), unused("__cuts", df), unused("__row", df)
    schema = T.StructType([T.StructField(own, df.schema[label].dataType), T.StructField(cut_names, T.ArrayType(T.LongType()))])
    cuts = df.sparkSession.createDataFrame(lookup, schema)
    # One row per class, at most ``max_classes``.
    numbered = with_row_index(df, [label, key], row).join(
        F.broadcast(cuts), quoted(label) == F.col(own), "inner"
    )
    passed = F.size(F.filter(cut_names, lambda cut: cut <= F.col(row)))
    return numbered.select(*[quoted(c) for c in df.columns], passed.alias(name))
