"""Scores of predictions and ranking of candidates."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.functions.scalar import round_half_even
from tabprep.operators.frame import insert_columns, quoted


def accuracy(prediction: Column, label: Column) -> Column:
    """Aggregate: share of rows whose prediction equals the label."""
    return F.avg((prediction == label).cast("double"))


def accuracy_by(df: DataFrame, keys, prediction: str, label: str, name: str = "score") -> DataFrame:
    return df.groupBy(*[quoted(k) for k in keys]).agg(accuracy(quoted(prediction), quoted(label)).alias(name))


def candidate_results(scores: DataFrame, candidate_keys, n_folds: int, fold: str = "fold", score: str = "score") -> DataFrame:
    """One row per candidate: score of each split, their mean and deviation, and rank.

    Population deviation; equal means share the lowest rank. Works on the table of
    scores (candidates x folds rows), so the unpartitioned rank sorts only that.
    """
    splits = [F.max(F.when(quoted(fold) == i, quoted(score))).alias(f"split{i}_test_score") for i in range(n_folds)]
    table = scores.groupBy(*[quoted(k) for k in candidate_keys]).agg(
        *splits, F.avg(quoted(score)).alias("mean_test_score"), F.stddev_pop(quoted(score)).alias("std_test_score")
    )
    # Equal accuracies may differ in the last bit after averaging; that is no difference.
    order = Window.orderBy(F.desc(F.round("mean_test_score", 12)))
    return table.withColumn("rank_test_score", F.rank().over(order).cast("bigint"))


def round_scores(results: DataFrame, digits: int = 3) -> DataFrame:
    """Round the score columns for show, ties to even."""
    return results.select(
        *[
            round_half_even(quoted(c), digits).alias(c) if c.endswith("_test_score") and c != "rank_test_score" else quoted(c)
            for c in results.columns
        ]
    )


def best_candidate(results: DataFrame, candidate: str = "candidate") -> DataFrame:
    """The candidate with the best mean score, the earliest of equal ones."""
    return results.orderBy("rank_test_score", quoted(candidate)).limit(1)


def submission(scored: DataFrame, key: str, label: str, prediction: str = "prediction") -> DataFrame:
    """(id, predicted label) rows."""
    return scored.select(quoted(key), quoted(prediction).cast("int").alias(label))


def with_prediction(scored: DataFrame, label: str, position: int = 1, prediction: str = "prediction") -> DataFrame:
    """The scored table with the predicted label at a position and nothing else of the scoring."""
    table = scored.drop(*[c for c in ("prediction", "probability", "rawPrediction") if c != prediction])
    moved = insert_columns(table, position, {label: quoted(prediction).cast("int")})
    return moved.drop(prediction)
