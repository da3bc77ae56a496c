"""Prefix trie of conversations by vertical bitmaps.

A shard holds the conversations of a range of ids, and a band of at most ``BAND`` turns of them, so that one very long
conversation is no more than its share in any task. Its index gives for each position and turn the bitset of
conversations that have it there. A node is a bitset too: depth first, the postings that meet a node's bitset are its children, their
intersections' popcounts its sizes, and the ids that end there its end list.

A prefix is named by a 128-bit xor of hashes of its turns at their positions, so the nodes of all shards and bands are merged by name. Each node's smallest
member names a chain of nodes below each other; what a subtree adds up to is a sum along the own chain and over
the chains of members that leave it further down: two aggregates, no rounds over depths.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabprep.llm.shared import forget, runs, stored

SHARD = 1000  # conversation ids of a shard
BAND = 128  # turns of a band
FAMILY = 5  # conversations that share the opening of their first
HEADS = 9
_NODES = "shard bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, depth bigint, n bigint, conv_id bigint, bytes bigint, members array<bigint>, ends string"
_LIST = pa.list_(pa.int64())
_KINDS = [*[pa.int64()] * 9, _LIST, pa.string()]
_NAMES = ["shard", "k1", "k2", "p1", "p2", "depth", "n", "conv_id", "bytes", "members", "ends"]


def positions(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, h1, h2, bytes`` of ``conv_id, turn, h1, h2, bytes``: the place of each row in its conversation.

    Rows are dealt by ranges of conversation and turn, so a conversation may span tasks. Each task numbers
    its own; those that go on from the tasks before, one at most for each task, are moved by a broadcast.
    """
    dealt = turns.repartitionByRange("conv_id", "turn", "h1", "h2").sortWithinPartitions("conv_id", "turn", "h1", "h2")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, so_far = TaskContext.get().partitionId(), None, 0
        for (conversation,), rows in runs(batches, ("conv_id",)):
            if conversation != last:
                last, so_far = conversation, 0
            own = np.arange(so_far, so_far + rows.num_rows, dtype=np.int64)
            so_far += rows.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows.num_rows, task, np.int32)), rows.column("conv_id"), pa.array(own), *[rows.column(c) for c in ("h1", "h2", "bytes")]],
                names=["task", "conv_id", "pos", "h1", "h2", "bytes"],
            )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in number(batches):
            held.append(batch)
            count += batch.num_rows
            if count >= 1 << 16:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, count = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    local = stored(dealt.mapInArrow(joined, "task int, conv_id bigint, pos bigint, h1 bigint, h2 bigint, bytes bigint"), "numbered")
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    moved = local.groupBy("conv_id", "task").count().withColumn("before", F.sum("count").over(before)).where("before > 0")
    rows = local.join(F.broadcast(moved.drop("count")), ["conv_id", "task"], "left")
    return rows.select("conv_id", (F.col("pos") + F.coalesce("before", F.lit(0))).alias("pos"), "h1", "h2", "bytes")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations of ``placed`` (see ``positions``): ``conv_id, total`` for each, and their turns ``conv_id, total, d, x1, x2, bytes``.

    The hashes ``x1, x2`` tell turn and position.
    """
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = placed.groupBy("conv_id").count().select("conv_id", F.col("count").alias("own"), base.alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"))
    opening = placed.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1)).groupBy(F.col("conv_id").alias("base"))
    opening = opening.agg(F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "bytes"))).alias("opening"))
    # Most turns of an opening: HEADS - 1.
    lead = F.least(F.col("h"), F.coalesce(F.size("opening"), F.lit(0)).cast("bigint"))
    conversations = own.join(opening, "base", "left").withColumn("lead", lead)
    conversations = stored(conversations.withColumn("total", F.col("lead") + F.greatest(F.col("own") - F.col("h"), F.lit(0).cast("bigint"))), "conversations")
    first = conversations.where("lead > 0").select("conv_id", "total", F.explode(F.slice("opening", F.lit(1), F.col("lead").cast("int"))).alias("t"))
    first = first.select("conv_id", "total", (F.col("t.pos") + 1).alias("d"), "t.h1", "t.h2", "t.bytes")
    rest = placed.join(conversations.select("conv_id", "total", "h", "lead"), "conv_id").where("pos >= h")
    rest = rest.select("conv_id", "total", (F.col("lead") + F.col("pos") - F.col("h") + 1).alias("d"), "h1", "h2", "bytes")
    turns = first.unionAll(rest).select("conv_id", "total", "d", F.xxhash64("d", "h1", "h2").alias("x1"), F.xxhash64("h2", "d", "h1").alias("x2"), "bytes")
    return conversations.select("conv_id", "total"), stored(turns, "rebuilt")


class _Shard:
    """The conversations of one shard and band, in the order of their ids."""

    def __init__(self, shard: int, number: int, band: int, columns: list[np.ndarray]) -> None:
        self.shard, self.base = shard, number * band
        conversation, d, x1, x2, size, total = columns
        begins = np.flatnonzero(np.r_[True, conversation[1:] != conversation[:-1]])
        self.ids = conversation[begins].tolist()
        lengths = np.diff(np.append(begins, len(conversation)))
        member = np.repeat(np.arange(len(begins)), lengths)
        self.begins, self.depths = begins.tolist(), (lengths - 1).tolist()
        # The row before the turns of a conversation has the name of what came before the band.
        self.start = list(zip(x1[begins].tolist(), x2[begins].tolist()))
        self.x1, self.x2, self.bytes = x1.tolist(), x2.tolist(), size.tolist()
        names = np.stack([d, x1, x2], axis=1)
        _, self.posting = np.unique(names, axis=0, return_inverse=True)
        self.posting = self.posting.reshape(-1).tolist()
        self.index: dict[int, int] = {}  # bitset of conversations for each position and turn
        for p, i in zip(self.posting, member.tolist()):
            self.index[p] = self.index.get(p, 0) | 1 << i
        self.goes_on = [0] * (band + 2)  # who has a turn after so many turns of the band
        self.ends: dict[int, int] = {}  # who ends after so many
        for i, (n, all_turns) in enumerate(zip(self.depths, total[begins].tolist())):
            for k in range(n):
                self.goes_on[k] |= 1 << i
            if all_turns == self.base + n:
                self.ends[n] = self.ends.get(n, 0) | 1 << i
        self.nodes: list[list] = [[] for _ in _NAMES]

    def members(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.ids[low.bit_length() - 1])
            bits ^= low
        return out

    def walk(self) -> Iterator[pa.RecordBatch]:
        roots: dict[tuple[int, int], int] = {}
        for i, name in enumerate(self.start):
            roots[name] = roots.get(name, 0) | 1 << i
        # Bitset, turns into the band, own name, name of the parent, bytes of the last turn.
        path = [(bits, 0, *name, None, None, 0) for name, bits in roots.items()]
        while path:
            bits, k, k1, k2, p1, p2, size = path.pop()
            if k or not self.base:
                members = self.members(bits)
                ends = bits & self.ends.get(k, 0)
                told = ",".join(map(str, members if ends == bits else self.members(ends))) if ends else None
                for column, value in zip(self.nodes, (self.shard, k1, k2, p1, p2, self.base + k, len(members), members[0], size, members, told)):
                    column.append(value)
                if len(self.nodes[0]) >= 20_000:
                    yield self.batch()
            left = bits & self.goes_on[k]
            while left:
                first = (left & -left).bit_length() - 1
                row = self.begins[first] + k + 1
                child = left & self.index[self.posting[row]]
                left ^= child
                path.append((child, k + 1, k1 ^ self.x1[row], k2 ^ self.x2[row], k1, k2, self.bytes[row]))
        if self.nodes[0]:
            yield self.batch()

    def batch(self) -> pa.RecordBatch:
        found = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.nodes, _KINDS)], names=_NAMES)
        self.nodes = [[] for _ in _NAMES]
        return found


def _walked(batches: Iterator[pa.RecordBatch], band: int) -> Iterator[pa.RecordBatch]:
    key, held = None, []
    columns = ("conv_id", "d", "x1", "x2", "bytes", "total")

    def nodes() -> Iterator[pa.RecordBatch]:
        if held:
            rows = pa.Table.from_batches(held)
            yield from _Shard(*key, band, [rows.column(c).to_numpy() for c in columns]).walk()

    for own, rows in runs(batches, ("shard", "band")):
        if own != key:
            yield from nodes()
            key, held = own, []
        held.append(rows)
    yield from nodes()


def shard_nodes(conversations: DataFrame, turns: DataFrame, shard: int = SHARD, band: int = BAND) -> DataFrame:
    """The nodes of each shard of ``shard`` ids and band of ``band`` turns; see ``rebuilt``."""
    number = F.floor((F.col("d") - 1) / band)
    bands = turns.where(F.col("total") > band).groupBy("conv_id", "total", number.alias("band")).agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    so_far = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    later = bands.select("conv_id", "total", (F.col("band") + 1).alias("band"), F.bit_xor("x1").over(so_far).alias("x1"), F.bit_xor("x2").over(so_far).alias("x2"))
    later = later.where(F.col("band") * band < F.col("total"))
    zero = F.lit(0).cast("bigint")
    starts = conversations.select("conv_id", "total", zero.alias("band"), zero.alias("x1"), zero.alias("x2")).unionAll(later)
    starts = starts.select("conv_id", "total", "band", (F.col("band") * band).alias("d"), "x1", "x2", zero.alias("bytes"))
    rows = starts.unionAll(turns.select("conv_id", "total", number.alias("band"), "d", "x1", "x2", "bytes"))
    rows = rows.withColumn("shard", F.floor(F.col("conv_id") / shard))
    return rows.repartition("shard", "band").sortWithinPartitions("shard", "band", "conv_id", "d").mapInArrow(lambda batches: _walked(batches, band), _NODES)


def _end_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the end list of each node, whose parts come in the order of their shards."""
    key, state = None, None
    out: list[tuple[int, int, str]] = []
    for own, rows in runs(batches, ("k1", "k2")):
        if own != key:
            if state is not None:
                out.append((*key, state.hexdigest()))
            key, state = own, None
        for part in rows.column("ends").to_pylist():
            if state is None:
                state = hashlib.sha256(part.encode())
            else:
                state.update(b"," + part.encode())
        if len(out) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["k1", "k2", "ends_sha256"])
            out = []
    if state is not None:
        out.append((*key, state.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["k1", "k2", "ends_sha256"])


def _chain_sums(nodes: DataFrame, size: int) -> DataFrame:
    """``nodes`` with ``leaves, saved`` summed from each node down its chain (the nodes of the same smallest member)."""
    band = ["conv_id", "band"]
    nodes = nodes.withColumn("band", F.floor(F.col("depth") / size))
    down = Window.partitionBy(*band).orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    further = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    below = nodes.groupBy(*band).agg(F.sum("leaf").alias("leaf"), F.sum("save").alias("save"))
    below = below.select(*band, F.sum("leaf").over(further).alias("more_leaves"), F.sum("save").over(further).alias("more_saved")).where("more_leaves IS NOT NULL")
    sums = nodes.withColumns({"leaves": F.sum("leaf").over(down), "saved": F.sum("save").over(down)}).join(below, band, "left")
    zero = F.lit(0)
    return sums.withColumns({"leaves": F.col("leaves") + F.coalesce("more_leaves", zero), "saved": F.col("saved") + F.coalesce("more_saved", zero)}).drop("band", "more_leaves", "more_saved")


def conversation_trie(
    conversations: DataFrame,
    *,
    conversation_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    shard: int = SHARD,
    band: int = BAND,
) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``: a row for each node of the trie.

    Every conversation c is rebuilt from the first h turns of conversation c - c % 5 (h is crc32 of its decimal id, modulo 9) and its own turns after its first h. A
    node is a distinct beginning of rebuilt conversations, named by the smallest id that has it, and its depth.

    Turns are ordered by number, nulls first, those of one number by a hash of role and text, so that repeated
    rows are turns of their own. Null roles and texts are empty. Rows without a conversation id belong to none and are left out. An empty
    table has no nodes; other columns aren't read. ``shard`` and ``band`` bound what a task holds.
    """
    texts = conversations.select(
        F.col(conversation_column).cast("bigint").alias("conv_id"),
        F.col(turn_column).alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_column, "role"), (text_column, "text"))],
    ).where("conv_id IS NOT NULL")
    # Role and text are told apart by the length of the role.
    hashed = texts.select(
        "conv_id",
        "turn",
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64("text", F.length("role"), "role").alias("h2"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )
    placed = stored(positions(stored(hashed, "turns")), "placed")
    all_conversations, turns = rebuilt(placed)
    local = stored(shard_nodes(all_conversations, turns, shard, band), "shard-nodes")
    forget(turns)

    name = ["k1", "k2"]
    merged = local.groupBy(*name).agg(
        F.min("depth").alias("depth"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes")
    )
    merged = stored(merged, "merged")
    children = merged.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    nodes = merged.join(children, name, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))
    nodes = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("bigint"), "save": (F.col("n") - 1) * F.col("bytes")})
    nodes = stored(_chain_sums(nodes, band), "nodes")
    chains = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), F.max_by("leaves", -F.col("depth")).alias("chain_leaves"), F.max_by("saved", -F.col("depth")).alias("chain_saved"))

    above = local.select(*name, "depth", F.explode("members").alias("conv_id")).join(chains, "conv_id").where("depth < top")
    above = above.groupBy(*name).agg(F.sum("chain_leaves").alias("other_leaves"), F.sum("chain_saved").alias("other_saved"))
    ends = local.where("ends IS NOT NULL").select(*name, "shard", "ends").repartition(*name).sortWithinPartitions(*name, "shard")
    ends = ends.mapInArrow(_end_lists, "k1 bigint, k2 bigint, ends_sha256 string")
    parents = merged.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    zero, no_ends = F.lit(0), hashlib.sha256().hexdigest()
    whole = nodes.join(above, name, "left").join(ends, name, "left").join(parents, ["p1", "p2"], "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        (F.col("leaves") + F.coalesce("other_leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("other_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(no_ends)).alias("ends_sha256"),
    )
