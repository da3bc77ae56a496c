"""Many penalised logistic fits advanced together, one scan of the data per step.

Tuning fits the same rows again and again with other penalties and other folds left
out. Each Newton step needs only sums over the rows, so one pass can form the sums of
every fit; with a handful of steps the whole search costs a handful of passes, where
fits run one by one cost passes x fits.

The curvature sums of a fit grow with the square of the number of features. Where a task can't hold those of all
fits, steps are quasi-Newton: curvature is learned from the gradients of the last steps, and started from its diagonal, so
that all sums are linear in the features. A step is one pass at any width, and both ways end at the same coefficients.
"""

import sys
from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

# The functions run in the tasks travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Numbers the curvature sums of all fits may take in a task.
CURVATURES = 4_000_000
# Steps that quasi-Newton fits remember.
_REMEMBERED = 20
# Partial sums are added up in so many groups before they meet.
_MERGE_GROUPS = 64
ALL_ROWS = -1
_BLOCK_ROWS = 4096
_BLOCK_BYTES = 8 << 20
# Feature pairs up to which a block's products are formed side by side (32 MB at most).
_PAIRS_AT_ONCE = 1000


@dataclass
class Fit:
    """One fit: a penalty strength, the fold left out, and the scale the penalty sees.

    Feature ``i`` enters as ``(x - low[i]) / width[i]``. ``point`` holds the
    coefficients on that scale and the intercept.
    """

    C: float
    fold: int
    low: np.ndarray
    width: np.ndarray
    point: np.ndarray
    ratio: np.ndarray | None = None
    shift: np.ndarray | None = None
    value: float = np.inf
    gradient: np.ndarray | None = None
    step: np.ndarray | None = None
    trial: np.ndarray | None = None
    past: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    steps: int = 0
    done: bool = False

    def from_scale(self, low: np.ndarray, width: np.ndarray) -> None:
        """Features on the fit's scale are ``ratio`` times those on the given one, plus ``shift``."""
        self.ratio, self.shift = width / self.width, (low - self.low) / self.width

    def weights(self, point: np.ndarray) -> np.ndarray:
        """Coefficients and intercept for features on the given scale."""
        return np.append(self.ratio * point[:-1], point[-1] + self.shift @ point[:-1])

    def own(self, sums: np.ndarray) -> np.ndarray:
        """Sums over features (and 1) on the given scale, as they are on the fit's."""
        return np.append(self.ratio * sums[:-1] + self.shift * sums[-1], sums[-1])


def new_fit(C: float, fold: int, low, width) -> Fit:
    return Fit(float(C), fold, np.asarray(low, "f8"), np.asarray(width, "f8"), np.zeros(len(low) + 1))


class RowBlocks:
    """The rows as matrices, built once and kept for all passes; close it when done.

    ``base`` is a (low, width) scale near which all fits lie; sums are formed on it,
    so that features of any size lose no digits.
    """

    def __init__(self, df: DataFrame, values: Sequence[Column], label: Column, weight: Column, fold: Column, base):
        self.low, self.width = (np.asarray(b, "f8") for b in base)
        columns = [*values, label, weight, fold]
        table = df.select(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
        self.blocks = table.mapInArrow(_to_blocks, "block binary").persist(StorageLevel.MEMORY_AND_DISK)

    def __enter__(self) -> "RowBlocks":
        return self

    def __exit__(self, *_) -> None:
        self.blocks.unpersist()

    def fit(self, fits: list[Fit], max_iter: int, tol: float, milestones: Collection[int] = ()) -> dict[int, list]:
        """Advance all fits until they settle; returns their points after the milestone steps."""
        for f in fits:
            f.from_scale(self.low, self.width)
        curved = len(fits) * (len(self.low) + 1) ** 2 <= 2 * CURVATURES
        reached = {}
        for iteration in range(1, max_iter + 1):
            active = [f for f in fits if not f.done]
            if not active:
                break
            self._advance(active, tol, curved)
            if iteration in milestones:
                reached[iteration] = [f.point for f in fits]
        return reached

    def _advance(self, fits: list[Fit], tol: float, curved: bool) -> None:
        """One scan: loss, gradient and curvature, or its diagonal, of every fit at its trial point, then a step."""
        for f in fits:
            f.trial = f.point if f.step is None else f.point + f.step
        weights = np.array([f.weights(f.trial) for f in fits])
        folds = np.array([f.fold for f in fits], "f8")
        low, width = self.low, self.width
        d = len(low)
        upper = np.triu_indices(d + 1) if curved else None

        def sums(batches):
            total = np.zeros((len(folds), d + 2 + (len(upper[0]) if curved else 2 * d + 1)))
            for x, y, w, fold in _open_blocks(batches, low, width):
                margin = x @ weights.T
                used = w[:, None] * (fold[:, None] != folds)
                small = np.exp(-np.abs(margin))
                p = np.where(margin >= 0, 1.0, small) / (1.0 + small)
                loss = np.maximum(margin, 0.0) + np.log1p(small) - y[:, None] * margin
                total[:, 0] += np.einsum("ij,ij->j", used, loss)
                total[:, 1 : d + 2] += (used * (p - y[:, None])).T @ x
                bent = used * p * (1.0 - p)
                if curved:
                    total[:, d + 2 :] += _curvatures(x, bent, upper)
                else:
                    total[:, d + 2 : 2 * d + 3] += bent.T @ x
                    total[:, 2 * d + 3 :] += bent.T @ (x[:, :d] ** 2)
            yield pa.record_batch(
                [pa.array(range(len(folds)), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], ["fit", "sums"]
            )

        # One row per fit and task, added up in two steps: no task receives those of all others.
        partial = self.blocks.mapInArrow(sums, "fit bigint, sums array<double>").select(
            "fit", array_to_vector("sums").alias("sums"), F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("merge_group")
        )
        merged = partial.groupBy("fit", "merge_group").agg(Summarizer.sum(F.col("sums")).alias("sums"))
        found = merged.groupBy("fit").agg(vector_to_array(Summarizer.sum(F.col("sums"))).alias("sums"))
        for row in found.toLocalIterator():
            if curved:
                _step(fits[row["fit"]], np.array(row["sums"]), upper, tol)
            else:
                _quasi_step(fits[row["fit"]], np.array(row["sums"]))

    def hits(self, points: Sequence[tuple[Fit, np.ndarray]]) -> list[int]:
        """Rows of its left-out fold each (fit, point) classifies right; one scan for all."""
        weights = np.array([f.weights(point) for f, point in points])
        folds = np.array([f.fold for f, _ in points], "f8")
        low, width = self.low, self.width

        def count(batches):
            right = np.zeros(len(folds), "i8")
            for x, y, _, fold in _open_blocks(batches, low, width):
                right += (((x @ weights.T > 0) == (y[:, None] > 0.5)) & (fold[:, None] == folds)).sum(axis=0)
            yield pa.record_batch([pa.array(range(len(folds)), pa.int64()), pa.array(right, pa.int64())], ["fit", "n"])

        found = self.blocks.mapInArrow(count, "fit bigint, n bigint").groupBy("fit").agg(F.sum("n").alias("n")).collect()
        right = {row["fit"]: row["n"] for row in found}
        return [right[i] for i in range(len(points))]


def _to_blocks(batches):
    """Arrow batches → row-major matrices, as bytes."""
    for batch in batches:
        if batch.num_rows:
            matrix = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype("f8")
            if np.isnan(matrix).any():
                raise ValueError("features, label and weight must not be missing")
            if not np.isin(matrix[:, -3], (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            most = max(1, min(_BLOCK_ROWS, _BLOCK_BYTES // (8 * matrix.shape[1])))
            for start in range(0, len(matrix), most):
                part = np.ascontiguousarray(matrix[start : start + most])
                yield pa.record_batch([pa.array([part.tobytes()], pa.binary())], ["block"])


def _open_blocks(batches, low, width):
    """Matrices → (features on the base scale with a 1 appended, label, weight, fold)."""
    d = len(low)
    for batch in batches:
        for value in batch.column(0):
            matrix = np.frombuffer(value.as_buffer(), "f8").reshape(-1, d + 3)
            x = np.column_stack([(matrix[:, :d] - low) / width, np.ones(len(matrix))])
            yield x, matrix[:, d], matrix[:, d + 1], matrix[:, d + 2]


def _curvatures(x, weights, upper):
    """Weighted sums of x xᵀ, one row of upper-triangle entries per column of weights."""
    if len(upper[0]) <= _PAIRS_AT_ONCE:
        return weights.T @ (x[:, upper[0]] * x[:, upper[1]])
    return np.array([(x.T @ (x * w[:, None]))[upper] for w in weights.T])


def _step(f: Fit, sums: np.ndarray, upper, tol: float) -> None:
    """Accept the trial point if the penalised loss fell, else halve the step."""
    d = len(f.low)
    penalty = np.append(np.full(d, 1.0 / f.C), 0.0)
    value = sums[0] + 0.5 * (penalty * f.trial**2).sum()
    f.steps += 1
    if f.step is not None and value > f.value * (1 + 1e-12):
        f.step = f.step / 2
        f.done = bool(np.abs(f.step).max() <= 1e-12 * max(np.abs(f.point).max(), 1.0))
        return
    f.done = f.step is not None and f.value - value <= tol * max(value, 1.0)
    f.point, f.value = f.trial, value
    gradient = f.own(sums[1 : d + 2]) + penalty * f.point
    half = np.zeros((d + 1, d + 1))
    half[upper] = sums[d + 2 :]
    lift = np.diag(np.append(f.ratio, 1.0))
    lift[:d, d] = f.shift
    curvature = lift @ (half + np.triu(half, 1).T) @ lift.T + np.diag(penalty)
    size = np.sqrt(np.maximum(np.diag(curvature), 1e-300))
    f.step = -np.linalg.lstsq(curvature / np.outer(size, size), gradient / size, rcond=None)[0] / size


def _quasi_step(f: Fit, sums: np.ndarray) -> None:
    """Accept the trial point if the penalised loss fell enough, else halve the step; the next one by the last gradients."""
    d = len(f.low)
    penalty = np.append(np.full(d, 1.0 / f.C), 0.0)
    value = sums[0] + 0.5 * (penalty * f.trial**2).sum()
    f.steps += 1
    size = max(np.abs(f.point).max(), 1.0)
    if f.step is not None and value > f.value + 1e-4 * (f.gradient @ f.step) + 1e-13 * abs(f.value):
        f.step = f.step / 2
        f.done = bool(np.abs(f.step).max() <= 1e-12 * size)
        return
    gradient = f.own(sums[1 : d + 2]) + penalty * f.trial
    if f.step is not None:
        change = gradient - f.gradient
        if f.step @ change > 1e-12 * np.linalg.norm(f.step) * np.linalg.norm(change):
            f.past = [*f.past, (f.step, change)][-_REMEMBERED:]
    f.point, f.value, f.gradient = f.trial, value, gradient
    bent, squares = sums[d + 2 : 2 * d + 3], sums[2 * d + 3 :]
    diagonal = f.ratio**2 * squares + 2 * f.ratio * f.shift * bent[:d] + f.shift**2 * bent[d]
    diagonal = np.append(np.maximum(diagonal, 0.0), max(bent[d], 1e-12)) + penalty
    step = -gradient
    kept = []
    for s, y in reversed(f.past):
        a = (s @ step) / (s @ y)
        kept.append(a)
        step = step - a * y
    step = step / diagonal
    if f.past:
        s, y = f.past[-1]
        step = step * ((s @ y) / (y @ (y / diagonal)))
    for (s, y), a in zip(f.past, reversed(kept)):
        step = step + s * (a - (y @ step) / (s @ y))
    f.step = step
    f.done = bool(np.abs(step).max() <= 1e-9 * size)
