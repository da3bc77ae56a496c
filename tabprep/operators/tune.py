"""Grid search for logistic regression over stratified folds."""

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.scalar import class_weight
from tabprep.operators.folds import evenly_spaced, log_spaced, parameter_grid, stratified_folds
from tabprep.operators.frame import quoted, unused
from tabprep.operators.models import LinearClassifier
from tabprep.operators.newton import ALL_ROWS, RowBlocks, new_fit
from tabprep.operators.scoring import candidate_results


@dataclass(frozen=True)
class GridResult:
    """Scores of all candidates and the best one, refitted on all rows."""

    results: DataFrame
    best: dict[str, Any]
    best_score: float
    model: LinearClassifier


def default_grid() -> dict[str, list]:
    return {"C": log_spaced(-3, 3, 7), "max_iter": evenly_spaced(100, 1000, 10)}


def grid_search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    grid: dict[str, list] | None = None,
    n_folds: int = 5,
    class_weights: dict | None = None,
    tol: float = 1e-9,
) -> GridResult:
    """Tune ``C`` and ``max_iter`` of min-max scaled logistic regression by fold accuracy.

    The scaler is fitted inside each fold. Every fit of the grid advances in the same scans, by
    the same steps whatever the number of features.
    """
    grid = grid or default_grid()
    # Features under plain names, so that none can be taken for a helper.
    names, fold = [f"f{i}" for i in range(len(features))], unused("__fold", df)
    folded = stratified_folds(df, label, key, n_folds, fold).select(
        *[quoted(f).cast("double").alias(n) for f, n in zip(features, names)],
        quoted(label).cast("double").alias("__label"),
        class_weight(quoted(label), class_weights).alias("__weight"),
        F.col(fold).alias("__fold"),
    )
    scores, refit = _all_at_once(folded, list(features), names, grid, n_folds, tol)
    candidates = parameter_grid(grid)
    rows = [
        (i, c["C"], c["max_iter"], fold, float(scores[c["C"], c["max_iter"]][fold]))
        for i, c in enumerate(candidates)
        for fold in range(n_folds)
    ]
    table = df.sparkSession.createDataFrame(
        rows, "candidate bigint, C double, max_iter bigint, fold int, score double"
    )
    table = table.withColumnsRenamed({"C": "param_C", "max_iter": "param_max_iter"})
    means = [round(float(np.mean(scores[c["C"], c["max_iter"]])), 12) for c in candidates]
    winner = int(np.argmax(means))
    results = candidate_results(table, ["candidate", "param_C", "param_max_iter"], n_folds)
    return GridResult(results, candidates[winner], means[winner], refit(candidates[winner]))


def _training_scales(folded: DataFrame, features, n_folds: int):
    """Minimum and width of each feature outside each fold, and the rows of each fold.

    One aggregate: the rows outside a fold are the other folds together.
    """
    per_fold = (
        folded.groupBy("__fold")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.min(quoted(n)) for n in features]).alias("low"),
            F.array(*[F.max(quoted(n)) for n in features]).alias("high"),
        )
        .collect()
    )
    if len(per_fold) != n_folds:
        raise ValueError("a fold is empty: too few rows")
    scales = {}
    for fold in (ALL_ROWS, *range(n_folds)):
        used = [r for r in per_fold if r["__fold"] != fold]
        low = np.min([r["low"] for r in used], axis=0)
        width = np.max([r["high"] for r in used], axis=0) - low
        scales[fold] = (low, np.where(width == 0, 1.0, width))
    return scales, {r["__fold"]: r["n"] for r in per_fold}


def _all_at_once(folded, features, names, grid, n_folds, tol):
    """All (C, fold) fits and the fits on all rows in common scans."""
    scales, fold_rows = _training_scales(folded, names, n_folds)
    fits = [new_fit(C, fold, *scales[fold]) for C in grid["C"] for fold in (ALL_ROWS, *range(n_folds))]
    values = [F.col(n) for n in names]
    with RowBlocks(
        folded, values, F.col("__label"), F.col("__weight"), F.col("__fold"), scales[ALL_ROWS]
    ) as blocks:
        reached = blocks.fit(fits, max(grid["max_iter"]), tol, grid["max_iter"])
        settled = [f.point for f in fits]
        # A limit beyond the last step changes nothing, so those values share their points.
        points = {m: reached.get(m, settled) for m in grid["max_iter"]}
        stages = {id(p): p for p in points.values()}
        judged = [(stage, i) for stage in stages for i, f in enumerate(fits) if f.fold != ALL_ROWS]
        hits = blocks.hits([(fits[i], stages[stage][i]) for stage, i in judged])
    found = {}
    for (stage, i), n in zip(judged, hits):
        f = fits[i]
        found.setdefault((stage, f.C), np.zeros(n_folds))[f.fold] = n / fold_rows[f.fold]
    scores = {(C, m): found[id(points[m]), float(C)] for C in grid["C"] for m in grid["max_iter"]}

    def refit(best):
        i = next(i for i, f in enumerate(fits) if f.fold == ALL_ROWS and f.C == best["C"])
        return LinearClassifier.from_point(features, points[best["max_iter"]][i], *scales[ALL_ROWS])

    return scores, refit
