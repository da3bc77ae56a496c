"""A network with one hidden layer of rectified units, trained in small shuffled batches.

Rows are dealt by a hash of their key into shards, whose number follows from the row count alone. In each epoch every shard goes
through its rows in an order of its own, a batch at a time with Adam, and the shards' weights and moments are averaged by
their rows for the next one. A small table is one shard, and so plain sequential training; a large one trains all shards at
once. What is fitted depends on the rows, the seed and the sizes given, not on how the rows were laid out.
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.functions.scalar import threshold
from tabprep.materialize import delete_folder, new_folder
from tabprep.operators.frame import quoted
from tabprep.operators.models import _present

# Most rows of a shard, and about how many bytes of features.
SHARD_ROWS = 1 << 16
SHARD_BYTES = 8 << 20
_MERGE_GROUPS = 32


def _functions(d: int, hidden: int) -> tuple[Callable, Callable]:
    """Output and gradient of a network of ``d`` features, its weights in one array; made here so that tasks need no import."""
    first, second, third = d * hidden, d * hidden + hidden, d * hidden + 2 * hidden

    def output(point, x):
        """Logit of each row, and the hidden units."""
        units = np.maximum(x @ point[:first].reshape(d, hidden) + point[first:second], 0.0)
        return units @ point[second:third] + point[third], units

    def gradient(point, x, y):
        """Mean logistic loss of the rows, and its gradient."""
        z, units = output(point, x)
        small = np.exp(-np.abs(z))
        loss = float(np.mean(np.maximum(z, 0.0) + np.log1p(small) - y * z))
        error = (np.where(z >= 0, 1.0, small) / (1.0 + small) - y) / len(y)
        back = np.outer(error, point[second:third]) * (units > 0)
        return loss, np.concatenate([(x.T @ back).reshape(-1), back.sum(axis=0), units.T @ error, [error.sum()]])

    return output, gradient


@dataclass(frozen=True)
class NetworkClassifier:
    """A fitted network over named columns; a missing feature raises."""

    features: tuple[str, ...]
    hidden: int
    point: np.ndarray

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (array, one entry per class) and ``prediction``; works on streams as well."""
        d, hidden, point = len(self.features), self.hidden, self.point
        output, _ = _functions(d, hidden)

        def chances(values):
            x = np.array(values.tolist(), "f8").reshape(len(values), d)
            z = output(point, x)[0]
            small = np.exp(-np.abs(z))
            return values.__class__(np.where(z >= 0, 1.0, small) / (1.0 + small))

        one = F.pandas_udf(chances, "double")(F.array(*[_present(quoted(f).cast("double")) for f in self.features]))
        own = "p"
        while own in df.columns:
            own = f"_{own}"
        names = [quoted(c) for c in df.columns]
        return df.select(*names, one.alias(own)).select(
            *names, F.array(1.0 - quoted(own), quoted(own)).alias("probability"), threshold(quoted(own), 0.5).cast("double").alias("prediction")
        )


def _packed(df: DataFrame, features: Sequence[str], label: str, key: str, shards: int, most: int) -> DataFrame:
    """``data``: each row the hashes, labels and features of one shard, in the order of the hashes."""
    d = len(features)
    wrong = F.raise_error(F.lit("labels must be 0 or 1")).cast("double")
    value = quoted(label).cast("double")
    rows = df.select(
        F.xxhash64(quoted(key)).alias("hash"),
        F.when(value.isin(0.0, 1.0), value).otherwise(wrong).alias("y"),
        F.array(*[_present(quoted(f).cast("double")) for f in features]).alias("x"),
    )

    def pack(batches):
        held, shard, count = [], None, 0

        def block():
            return pa.record_batch([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["data"])

        for batch in batches:
            own = batch.column("shard").to_numpy()
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            table = np.column_stack([batch.column("hash").to_numpy().view("f8"), batch.column("y").to_numpy(), x])
            bounds = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for begin, stop in zip(bounds, bounds[1:]):
                # Rows of one key may be many: then they are several shards.
                if begin < stop and (own[begin] != shard or count >= 2 * most):
                    if held:
                        yield block()
                    held, shard, count = [], own[begin], 0
                if begin < stop:
                    held.append(table[begin:stop].copy())
                    count += stop - begin
        if held:
            yield block()

    dealt = rows.withColumn("shard", F.pmod(F.col("hash"), F.lit(shards))).repartition("shard").sortWithinPartitions("shard", "hash", "y", "x")
    return dealt.mapInArrow(pack, "data binary")


def fit_relu_network(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    hidden: int = 128,
    epochs: int = 10,
    batch_size: int = 64,
    rate: float = 0.001,
    seed: int = 0,
    shard_rows: int = SHARD_ROWS,
) -> NetworkClassifier:
    """Rectified units, Adam on the logistic loss of the output's logit, small batches in a new order each epoch.

    ``key`` should be unique; rows of one key keep a fixed order. Missing features and labels other than 0 and 1 raise, as does an empty table.
    """
    d = len(features)
    size = d * hidden + 2 * hidden + 1
    total = df.count()
    if not total:
        raise ValueError("no rows to learn from")
    most = max(batch_size, min(shard_rows, SHARD_BYTES // (8 * (d + 2))))
    shards = -(-total // most)
    dice = np.random.default_rng(seed)
    ranges = [(d * hidden + hidden, d), (hidden + 1, hidden)]
    point = np.concatenate([dice.uniform(-1.0, 1.0, n) / np.sqrt(max(fan, 1)) for n, fan in ranges])
    state = np.concatenate([point, np.zeros(2 * size + 1)])  # weights, both moments, steps
    _, gradient = _functions(d, hidden)

    def shuffled(hashes: np.ndarray, number: int) -> np.ndarray:
        """The order of a shard's rows in one epoch."""
        mixed = hashes + np.uint64(seed * 1_000_003 + number + 1) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
        return np.argsort(mixed ^ (mixed >> np.uint64(31)), kind="stable")

    def advance(table: DataFrame, numbers: range, start: np.ndarray) -> np.ndarray:
        """The state after some epochs without a mean between them."""

        def train(batches):
            sums = np.zeros(len(start) + 1)
            for batch in batches:
                for data in batch.column("data"):
                    rows = np.frombuffer(data.as_buffer(), "f8").reshape(-1, d + 2)
                    hashes = np.ascontiguousarray(rows[:, 0]).view("u8")
                    w, m, v, steps = start[:size].copy(), start[size : 2 * size].copy(), start[2 * size : 3 * size].copy(), start[-1]
                    for number in numbers:
                        order = shuffled(hashes, number)
                        for begin in range(0, len(order), batch_size):
                            own = rows[order[begin : begin + batch_size]]
                            _, g = gradient(w, own[:, 2:], own[:, 1])
                            steps += 1
                            m = 0.9 * m + 0.1 * g
                            v = 0.999 * v + 0.001 * g * g
                            w -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
                    sums += len(rows) * np.append(np.concatenate([w, m, v, [steps]]), 1.0)
            yield pa.record_batch([pa.array([sums], pa.list_(pa.float64()))], ["sums"])

        # One row per task, added up in two steps.
        partial = table.mapInArrow(train, "sums array<double>")
        partial = partial.select(array_to_vector("sums").alias("sums"), F.pmod(F.spark_partition_id(), F.lit(_MERGE_GROUPS)).alias("part"))
        merged = partial.groupBy("part").agg(Summarizer.sum(F.col("sums")).alias("sums"))
        found = np.array(merged.agg(vector_to_array(Summarizer.sum(F.col("sums"))).alias("sums")).first()["sums"])
        return found[:-1] / found[-1]

    spark = df.sparkSession
    folder = new_folder(spark, "network")
    _packed(df, features, label, key, shards, most).write.parquet(folder)
    table = spark.read.schema("data binary").parquet(folder)
    # One shard needs no means, so all its epochs are one job.
    at_once = max(epochs, 1) if table.count() == 1 else 1
    for number in range(0, epochs, at_once):
        state = advance(table, range(number, min(number + at_once, epochs)), state)
    delete_folder(spark, folder)
    return NetworkClassifier(tuple(features), hidden, state[:size])
