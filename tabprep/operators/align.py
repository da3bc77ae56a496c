"""Row position for tables that have none, and joins on it."""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabprep.errors import ColumnConflictError, KeyColumnError
from tabprep.materialize import materialize
from tabprep.operators.frame import one_per_key, quoted, unused

# monotonically_increasing_id keeps the partition number above bit 33 and the
# position inside the partition below it.
_POSITION_BITS = 33


def with_row_index(df: DataFrame, keys, name: str = "row_index", partitions: int | None = None) -> DataFrame:
    """Number the rows 0, 1, 2, … in the order of a unique key.

    Only the keys are numbered: a range shuffle spreads them evenly, each partition numbers its
    own ones and adds the size of the partitions before it. The rows then get their
    numbers by a join on the key, and no more than keys is ever stored. Nothing passes through
    a single task: the only thing gathered is one count per partition. Missing or
    repeated keys raise, since their order would be arbitrary.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    mark = unused("__key", df)
    names = [f"{mark}{i}" for i in range(len(keys))]
    alone = df.select(*[quoted(k).alias(n) for k, n in zip(keys, names)])
    columns = [F.col(n) for n in names]
    spread = alone.repartitionByRange(partitions, *columns) if partitions else alone.repartitionByRange(*columns)
    # The window needs equal keys together and sorted, which the range shuffle gives:
    # no second shuffle.
    copies = F.row_number().over(Window.partitionBy(*columns).orderBy(*columns))
    no_key = F.lit(False)
    for column in columns:
        no_key = no_key | column.isNull()
    tagged = materialize(
        spread.sortWithinPartitions(*columns)
        .withColumn("__bad", (copies > 1) | no_key)
        .withColumn("__tag", F.monotonically_increasing_id())
    )
    partition = F.shiftright("__tag", _POSITION_BITS)
    sizes = (
        tagged.groupBy(partition.alias("part"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("__bad").alias("bad"))
        .orderBy("part")
        .collect()
    )
    if any(row["bad"] for row in sizes):
        raise KeyColumnError(f"key {keys} has missing or repeated values")
    offsets, total = [], 0
    for row in sizes:
        offsets.append((row["part"], total))
        total += row["n"]
    lookup = df.sparkSession.createDataFrame(offsets, "__part bigint, __offset bigint")
    position = F.col("__tag").bitwiseAND((1 << _POSITION_BITS) - 1)
    # One row per shuffle partition, so the broadcast side is bounded by their number.
    numbered = (
        tagged.withColumn("__part", partition)
        .join(F.broadcast(lookup), "__part")
        .select(*names, (position + F.col("__offset")).alias(name))
    )
    same = functools.reduce(Column.__and__, [quoted(k) == F.col(n) for k, n in zip(keys, names)])
    return df.join(numbered, same).select(*[quoted(c) for c in df.columns], quoted(name))


def with_file_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Number the rows of a table read from files 0, 1, 2, … in the order they stand there, files by their paths.

    ``df`` is a file scan with projections only, of files that don't change meanwhile. Tasks read blocks of files, whose places
    Spark tells; one count for each block says what stands before it, and a row's place in its block is its place in
    the scan. No rows are shuffled or sorted, only the counts.
    """
    path, block, tag, first, before = (unused(f"__{n}", df) for n in ("path", "block", "tag", "first", "before"))
    place = [F.col("_metadata.file_path").alias(path), F.col("_metadata.file_block_start").alias(block), F.monotonically_increasing_id().alias(tag)]
    rows = df.select(*[quoted(c) for c in df.columns], *place)
    blocks = rows.groupBy(path, block).agg(F.count(F.lit(1)).alias("n"), F.min(tag).alias(first))
    ahead = Window.orderBy(path, block).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn(before, F.coalesce(F.sum("n").over(ahead), F.lit(0))).select(path, block, first, before)
    found = rows.join(materialize(starts), [path, block])
    return found.select(*[quoted(c) for c in df.columns], (F.col(before) + F.col(tag) - F.col(first)).alias(name))


def positional_concat(
    left: DataFrame,
    right: DataFrame,
    left_key=None,
    right_key=None,
    position: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Put two tables side by side by row position, in the order of their keys, or of their files where a table has no key.

    The shorter side is padded with NULL. ``position`` inserts the right columns at
    that place instead of at the end.
    """
    taken = sorted(set(left.columns).intersection(right.columns))
    if taken:
        raise ColumnConflictError(f"both tables have columns {taken}")
    index = unused("__row", left, right)
    sides = [
        with_file_index(df, index) if key is None else with_row_index(df, key, index, partitions)
        for df, key in ((left, left_key), (right, right_key))
    ]
    joined = sides[0].join(sides[1], index, "full")
    at = len(left.columns) if position is None else position
    order = [*left.columns[:at], *right.columns, *left.columns[at:]]
    return joined.select(*[quoted(c) for c in order])


def join_by_key(ids: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Bring predictions to their ids by key.

    Every id stays, with NULL where it has no prediction; a key that the predictions repeat raises.
    """
    return ids.join(one_per_key(predictions, key), key, "left")
