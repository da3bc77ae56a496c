"""Shards of nearly equal bytes by Karmarkar-Karp differencing, with equal texts kept together.

A partial partition is a tuple of loads, one per shard. Differencing combines the two partial
partitions with the largest spread, the largest load of one with the smallest of the other, until one is
left. It needs all groups in one place, so the groups of equal texts are dealt out:

* the heaviest ones (at most ``HEAVY_GROUPS``, whatever the table) are differenced first. Where a group
  alone exceeds a fair share, it thereby gets a shard of its own;
* the others go by hash into blocks of some ten thousand, one task each. A block begins with
  a partial partition for what the heavy groups have left unequal, in proportion to its bytes, and
  differences its own groups against it.

Each block thus ends level to a few bytes, and so does their sum. Only sizes and hashes are
shuffled; a group is one row, however many copies it has.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.shared import forget, id_and_text, stored

HEAVY_GROUPS = 4096
BLOCK_GROUPS = 16_384
_ROW_BYTES = 16
_BUCKET_ROWS = 50_000


def difference(weights: list[int], shards: int, loads: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each weight, and what each shard gets, by differencing.

    ``loads`` is what the shards hold already: a partial partition like any other, whose places name the shards.
    """
    places = np.arange(shards)
    first = np.zeros(shards) if loads is None else np.asarray(loads, np.float64)
    order = np.argsort(-first, kind="stable")
    name_of = places[order]
    # Nodes: 0 is ``loads``, 1..n the weights, then the combinations.
    sums: list[np.ndarray | None] = [first[order] - first.min()]
    for w in weights:
        leaf = np.zeros(shards)
        leaf[0] = w
        sums.append(leaf)
    heap = [(-float(s[0] - s[-1]), n) for n, s in enumerate(sums)]
    heapq.heapify(heap)
    made: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heap[0]
        joint = sums[a] + sums[b][::-1]
        by_load = np.argsort(-joint, kind="stable")
        joint = joint[by_load]
        joint -= joint[-1]
        sums[a] = sums[b] = None
        made.append((a, b, by_load))
        sums.append(joint)
        heapq.heapreplace(heap, (-float(joint[0]), len(sums) - 1))
    count = len(weights) + 1
    slots: list[np.ndarray | None] = [None] * len(sums)  # final place of each place of a node
    slots[-1] = places
    for n in range(len(made) - 1, -1, -1):
        a, b, by_load = made[n]
        joint = np.empty(shards, np.int64)
        joint[by_load] = slots[count + n]
        slots[count + n] = None
        slots[a], slots[b] = joint, joint[::-1]
    shard_of_place = np.empty(shards, np.int64)
    shard_of_place[slots[0]] = name_of
    chosen = shard_of_place[np.array([int(s[0]) for s in slots[1:count]], np.int64)] if weights else np.zeros(0, np.int64)
    return chosen, np.bincount(chosen, weights=weights if weights else None, minlength=shards)


def water_level(loads: np.ndarray, amount: float) -> np.ndarray:
    """How much each shard gets of ``amount`` so that the lowest loads rise to one level."""
    ordered = np.sort(loads)
    for n in range(len(ordered), 0, -1):
        level = (ordered[:n].sum() + amount) / n
        if level >= ordered[n - 1]:
            break
    return np.maximum(level - loads, 0)


def shard_by_bytes(
    docs: DataFrame,
    shards: int,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    heavy_groups: int = HEAVY_GROUPS,
    block_groups: int = BLOCK_GROUPS,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for each row; rows of equal texts share a shard.

    ``size`` is the text's UTF-8 bytes plus 16; a null text counts as empty and goes with the empty
    ones. ``slot`` numbers the rows of a shard from 0 without gap. Ids may repeat or be null; an empty
    table gives no rows; other columns aren't read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = id_and_text(docs, id_column, text_column).select(
        "doc_id",
        (F.octet_length(text) + F.lit(_ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("group"),
        F.monotonically_increasing_id().alias("row"),
    )
    sized = stored(rows, "sized")
    groups = stored(sized.groupBy("group").agg(F.sum("size").alias("weight")), "groups")
    # Powers of two of the weight: 64 rows at most.
    by_power = groups.groupBy(F.floor(F.log2("weight")).alias("power")).agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
    powers = sorted(by_power.collect(), key=lambda r: -r.power)
    held, least = 0, None
    for r in powers:
        if held + r.n > heavy_groups:
            break
        held, least = held + r.n, r.power
    power = F.floor(F.log2("weight"))
    heavy = groups.where(power >= least).collect() if least is not None else []  # at most ``heavy_groups`` rows
    heavy.sort(key=lambda r: (-r.weight, bytes(r.group)))
    chosen, loads = difference([r.weight for r in heavy], shards)
    light = groups if least is None else groups.where(power < least)
    light_groups, light_bytes = (sum(getattr(r, c) for r in powers if least is None or r.power < least) for c in ("n", "weight"))
    shares = water_level(loads, light_bytes)
    blocks = max(1, -(-light_groups // block_groups))

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("weight", "descending"), ("group", "ascending")])
        weights = table.column("weight").to_pylist()
        open_ = (shares.max() - shares) * (sum(weights) / max(light_bytes, 1))
        own, _ = difference(weights, shards, open_)
        return pa.table({"group": table.column("group"), "shard": pa.array(own, pa.int32())})

    dealt = light.withColumn("block", F.pmod(F.xxhash64("group"), F.lit(blocks))).groupBy("block")
    light_shards = dealt.applyInArrow(place, "group binary, shard int")
    spark = docs.sparkSession
    heavy_shards = spark.createDataFrame([(r.group, int(s)) for r, s in zip(heavy, chosen)], "group binary, heavy_shard int")
    # The hot groups are among the heavy ones, so what is shuffled by group has none.
    with_heavy = sized.join(F.broadcast(heavy_shards), "group", "left")
    in_heavy = with_heavy.where("heavy_shard IS NOT NULL").withColumnRenamed("heavy_shard", "shard")
    in_light = with_heavy.where("heavy_shard IS NULL").drop("heavy_shard").join(light_shards, "group")
    buckets = F.lit(max(1, -(-sized.count() // _BUCKET_ROWS)))
    columns = ["doc_id", "size", "text_crc32", "shard", "row", F.pmod(F.xxhash64("row"), buckets).cast("int").alias("bucket")]
    placed = stored(in_heavy.select(*columns).unionAll(in_light.select(*columns)), "placed")
    forget(sized)
    forget(groups)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "row")) - 1
    numbered = placed.withColumn("within", within).join(offsets, ["shard", "bucket"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).cast("bigint").alias("slot"))
