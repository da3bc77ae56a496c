"""The whole ways from two raw tables to profiles or predictions.

A train table has a label and a unique key, a test table the key only. Every step
takes column names as arguments; nothing is tied to one data set.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from tabprep.operators.frame import quoted, select_columns
from tabprep.operators.impute import fit_imputer
from tabprep.operators.models import (
    class_probabilities,
    fit_forest,
    fit_logistic,
    with_threshold,
)
from tabprep.operators.network import fit_relu_network
from tabprep.operators.prepare import fit_column_transformer, prepare_pair
from tabprep.operators.profile import Profile, profile
from tabprep.operators.scoring import submission
from tabprep.operators.tune import GridResult, grid_search


@dataclass(frozen=True)
class Outcome:
    """Predictions for the test table and what led to them."""

    submission: DataFrame
    scored: DataFrame
    model: Any
    features: tuple[str, ...]
    search: GridResult | None = None


def analyze(tables: dict[str, DataFrame], key: str) -> dict[str, Profile]:
    """Profile each table: preview, statistics, missing values, value counts."""
    return {name: profile(table, key) for name, table in tables.items()}


def _prepared(train, test, columns, encode, label, key, per_frame, method, max_categories):
    """The used columns of the train table, kept; both tables prepared; the features.

    Every fit reads the kept columns: what leads to the train table is worked out once, and
    preparing is a projection too cheap to keep a second copy of its result.
    """
    used = select_columns(train, [key, label, *columns]).persist(StorageLevel.MEMORY_AND_DISK)
    ready, other = prepare_pair(used, test, columns, encode, 1, per_frame, ([key, label], [key]), method, max_categories)
    return used, ready, other, tuple(other.columns[1:])


def tune_and_predict(
    train: DataFrame,
    test: DataFrame,
    columns: Sequence[str],
    encode: Sequence[str],
    label: str,
    key: str,
    class_weights: dict | None = None,
    grid: dict[str, list] | None = None,
    per_frame: bool = False,
    method: str = "mean",
    max_categories: int = 1000,
) -> Outcome:
    """Prepare both tables, search the grid of logistic regressions, predict with the best."""
    used, ready, other, features = _prepared(train, test, columns, encode, label, key, per_frame, method, max_categories)
    try:
        search = grid_search(ready, features, label, key, grid, class_weights=class_weights)
    finally:
        used.unpersist()
    scored = search.model.transform(other)
    return Outcome(submission(scored, key, label), scored, search.model, features, search)


def logistic_predict(
    train: DataFrame,
    test: DataFrame,
    columns,
    encode,
    label: str,
    key: str,
    C: float = 10.0,
    max_iter: int = 1000,
    class_weights: dict | None = None,
    per_frame: bool = False,
    method: str = "mean",
    max_categories: int = 1000,
) -> Outcome:
    """One unscaled logistic regression with given parameters."""
    used, ready, other, features = _prepared(train, test, columns, encode, label, key, per_frame, method, max_categories)
    try:
        model = fit_logistic(ready, features, label, C, max_iter, class_weights)
    finally:
        used.unpersist()
    scored = model.transform(other)
    return Outcome(submission(scored, key, label), scored, model, features)


def forest_predict(
    train: DataFrame,
    test: DataFrame,
    columns,
    encode,
    label: str,
    key: str,
    n_trees: int = 1000,
    max_depth: int = 5,
    seed: int = 0,
    per_frame: bool = False,
    method: str = "mean",
    max_categories: int = 1000,
    partitions: int = 32,
) -> Outcome:
    """Random forest on the prepared features, the same however the rows are laid out."""
    used, ready, other, features = _prepared(train, test, columns, encode, label, key, per_frame, method, max_categories)
    try:
        model = fit_forest(ready, features, label, n_trees, max_depth, seed, key, partitions)
    finally:
        used.unpersist()
    scored = model.transform(other)
    return Outcome(submission(scored, key, label), scored, model, features)


def network_predict(
    train: DataFrame,
    test: DataFrame,
    numeric,
    categorical,
    label: str,
    key: str,
    epochs: int = 10,
    seed: int = 0,
    per_frame: bool = False,
    max_categories: int = 1000,
    method: str = "mean",
    hidden: int = 128,
    batch_size: int = 64,
) -> Outcome:
    """Standardise and encode, fit the network in small shuffled batches, decide at probability 0.5."""
    used = select_columns(train, [key, label, *numeric, *categorical]).persist(StorageLevel.MEMORY_AND_DISK)
    transformer = fit_column_transformer(used, numeric, categorical, max_categories=max_categories, method=method)
    own_fill = fit_imputer(test.select(*[quoted(c) for c in [*numeric, *categorical]]), method, 0) if per_frame else None
    ready = transformer.transform(used, keys=[key, label])
    try:
        model = fit_relu_network(ready, transformer.feature_names, label, key, hidden, epochs, batch_size, seed=seed)
    finally:
        used.unpersist()
    scored = with_threshold(model.transform(transformer.transform(test, [key], own_fill)))
    return Outcome(submission(scored, key, label), scored, model, tuple(transformer.feature_names))


def probabilities(outcome: Outcome, key: str, label: str) -> DataFrame:
    """(id, probability of each class), rounded to 3 digits."""
    return class_probabilities(outcome.scored, key, label)
