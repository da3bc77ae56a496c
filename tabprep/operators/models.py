"""Classifiers: fitting through Spark ML, scoring as plain columns."""

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.functions.scalar import class_weight, round_half_even, sigmoid, threshold
from tabprep.operators.frame import quoted, unused
from tabprep.operators.scale import Scaler, fit_min_max

FEATURES = "__features"
WEIGHT = "__weight"


def _present(value: Column) -> Column:
    """The value; one that is missing raises."""
    wrong = F.raise_error(F.lit("features, label and weight must not be missing")).cast("double")
    return F.when(value.isNull() | F.isnan(value), wrong).otherwise(value)


@dataclass(frozen=True)
class LinearClassifier:
    """A fitted two-class linear model, applied as one arithmetic expression.

    No vector column and no Python in the scoring path; works on streams as well. A
    missing feature raises, as it does when fitting.
    An optional scaler is part of the model, so scoring can never skip it.
    """

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    scaler: Scaler | None = None

    @classmethod
    def from_point(cls, features, point, low=None, width=None) -> "LinearClassifier":
        """From coefficients and intercept in one array, and the scale they belong to."""
        scaler = None
        if low is not None:
            scaler = Scaler(*({f: float(v) for f, v in zip(features, values)} for values in (low, width)))
        return cls(tuple(features), tuple(float(c) for c in point[:-1]), float(point[-1]), scaler)

    def margin(self) -> Column:
        terms = [F.lit(self.intercept)]
        for name, weight in zip(self.features, self.coefficients):
            value = self.scaler.scaled(name) if self.scaler else quoted(name).cast("double")
            terms.append(F.lit(weight) * value)
        # Added in pairs, so that many features do not nest as deeply as they are many.
        while len(terms) > 1:
            pairs = [a + b for a, b in zip(terms[::2], terms[1::2])]
            terms = pairs + terms[len(pairs) * 2 :]
        return terms[0]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (array, one entry per class) and ``prediction``."""
        one = sigmoid(_present(self.margin()))
        p = unused("__p", df)
        return df.withColumn(p, one).select(
            *[quoted(c) for c in df.columns],
            F.array(1.0 - F.col(p), F.col(p)).alias("probability"),
            threshold(F.col(p), 0.5, inclusive=False).cast("double").alias("prediction"),
        )

    def scores(self, df: DataFrame, digits: int = 3) -> DataFrame:
        """(feature, score): the coefficients, rounded."""
        return feature_scores(df, self.features, self.coefficients, digits)


@dataclass(frozen=True)
class VectorClassifier:
    """A fitted Spark ML classifier over named columns."""

    features: tuple[str, ...]
    model: Model
    scaler: Scaler | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(assemble(df, self.features, self.scaler))
        return scored.withColumn("probability", vector_to_array("probability")).drop(FEATURES, "rawPrediction")

    def scores(self, df: DataFrame, digits: int = 3) -> DataFrame:
        """(feature, score): the feature importances, rounded."""
        return feature_scores(df, self.features, self.model.featureImportances.toArray(), digits)


def feature_scores(df: DataFrame, names: Sequence[str], values, digits: int) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, np.round(values, digits))]
    return df.sparkSession.createDataFrame(rows, "feature string, score double")


def class_probabilities(scored: DataFrame, key: str, label: str, digits: int = 3, n_classes: int = 2) -> DataFrame:
    """(id, <label>_0, <label>_1): rounded class probabilities."""
    return scored.select(
        quoted(key),
        *[round_half_even(F.col("probability")[i], digits).alias(f"{label}_{i}") for i in range(n_classes)],
    )


def assemble(df: DataFrame, features: Sequence[str], scaler: Scaler | None = None) -> DataFrame:
    """Add the feature vector next to the table's own columns; a missing feature raises."""
    mark = unused("__f", df)
    names = [f"{mark}{i}" for i in range(len(features))]
    values = [_present(scaler.scaled(f) if scaler else quoted(f).cast("double")).alias(n) for f, n in zip(features, names)]
    wide = df.select(*[quoted(c) for c in df.columns], *values)
    return VectorAssembler(inputCols=names, outputCol=FEATURES).transform(wide).drop(*names)


def _training(df, features, label, scaler=None, weight=None) -> DataFrame:
    """Feature vector, label and weight; a missing feature or a label that is neither 0 nor 1 raises."""
    wrong = F.raise_error(F.lit("labels must be 0 or 1")).cast("double")
    value = quoted(label).cast("double")
    vectors = assemble(df, features, scaler).withColumn(label, F.when(value.isin(0.0, 1.0), value).otherwise(wrong))
    columns = [FEATURES, quoted(label)]
    return vectors.select(*columns, *([] if weight is None else [weight.alias(WEIGHT)]))


def fit_logistic(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    C: float = 1.0,
    max_iter: int = 100,
    class_weights: dict | None = None,
    scale: bool = False,
    tol: float = 1e-12,
) -> LinearClassifier:
    """L2-regularised logistic regression, ``C`` being the inverse penalty strength.

    ``scale`` fits a min-max scaler first and keeps it inside the model. Missing
    features and labels other than 0 and 1 raise.
    """
    weight = class_weight(quoted(label), class_weights)
    scaler = fit_min_max(df, features) if scale else None
    training = _training(df, features, label, scaler, weight).persist()
    try:
        total = training.agg(F.sum(WEIGHT)).first()[0]
        model = LogisticRegression(
            featuresCol=FEATURES,
            labelCol=label,
            weightCol=WEIGHT,
            # Spark divides the loss by the weight sum, so the penalty is divided by it too.
            regParam=1.0 / (C * total),
            elasticNetParam=0.0,
            # Penalties hold for the coefficients as they are, whatever the features' sizes.
            standardization=False,
            family="binomial",
            maxIter=max_iter,
            tol=tol,
        ).fit(training)
    finally:
        training.unpersist()
    coefficients = tuple(float(c) for c in model.coefficients)
    return LinearClassifier(tuple(features), coefficients, float(model.intercept), scaler)


def _laid_out(df: DataFrame, key: str | None, partitions: int) -> DataFrame:
    """Rows in a fixed number of partitions by the hash of their key, in key order.

    Tree fitting draws its samples partition by partition; so laid out, the same rows
    give the same trees however they came. Without a key the rows stay as they are.
    """
    return df if key is None else df.repartition(partitions, quoted(key)).sortWithinPartitions(quoted(key))


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    n_trees: int = 1000,
    max_depth: int = 5,
    seed: int = 0,
    key: str | None = None,
    partitions: int = 32,
    memory_mb: int = 1024,
) -> VectorClassifier:
    """Random forest with gini splits over the square root of the features.

    With a unique ``key`` the forest depends on the rows, the seed and ``partitions`` alone, not on
    how the rows were laid out. ``memory_mb`` is what a task may hold of node statistics: more of it
    means fewer scans.
    """
    forest = RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        numTrees=n_trees,
        maxDepth=max_depth,
        impurity="gini",
        featureSubsetStrategy="sqrt",
        seed=seed,
        maxMemoryInMB=memory_mb,
    )
    return VectorClassifier(tuple(features), forest.fit(_training(_laid_out(df, key, partitions), features, label)))


def fit_boosting(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    n_rounds: int = 20,
    max_depth: int = 5,
    seed: int = 0,
    key: str | None = None,
    partitions: int = 32,
) -> VectorClassifier:
    """Gradient-boosted trees for two classes; ``key`` and ``partitions`` as in ``fit_forest``."""
    boosting = GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=n_rounds, maxDepth=max_depth, seed=seed)
    return VectorClassifier(tuple(features), boosting.fit(_training(_laid_out(df, key, partitions), features, label)))


def fit_network(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    hidden: int = 128,
    max_iter: int = 10,
    block_size: int = 64,
    seed: int = 0,
) -> VectorClassifier:
    """Network with one hidden layer, trained by full passes over the data."""
    network = MultilayerPerceptronClassifier(
        featuresCol=FEATURES,
        labelCol=label,
        layers=[len(features), hidden, 2],
        maxIter=max_iter,
        blockSize=block_size,
        seed=seed,
    )
    return VectorClassifier(tuple(features), network.fit(_training(df, features, label)))


def with_threshold(scored: DataFrame, cut: float = 0.5, inclusive: bool = True) -> DataFrame:
    """Decide again from the probability of class 1, by default counting the cut itself as 1."""
    return scored.withColumn("prediction", threshold(F.col("probability")[1], cut, inclusive).cast("double"))
