"""Packing documents into token sequences: first fit decreasing in randomised groups.

Documents are cut into pieces of a full sequence and a rest. The pieces are dealt at random
into groups of some thousands; in each group the longest piece goes first, into
the first sequence that has room. A tournament tree over the sequences, whose nodes hold the largest room below
them, finds that sequence in a logarithm of steps. Groups don't know of each other, so the
work spreads over any number of tasks, and a group wastes no more than its last sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.shared import id_and_text, pieces, stored, strings, type_of
from tabprep.llm.tokens import REMEMBERED_BYTES, encoder, public_path

CAPACITY = 1024
GROUP_PIECES = 8192
_BINS = 1 << 24  # sequence ids of a group


class RoomTree:
    """Rooms of bins, all empty at first, as a tournament: each node has the largest room below it."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.rooms = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> int:
        """Take ``size`` from the first bin that has it; gives the bin."""
        rooms, node = self.rooms, 1
        while node < self.leaves:
            node *= 2
            if rooms[node] < size:
                node += 1
        bin_ = node - self.leaves
        rooms[node] -= size
        while node > 1:
            node //= 2
            best = max(rooms[2 * node], rooms[2 * node + 1])
            if rooms[node] == best:
                break
            rooms[node] = best
        return bin_


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size; equal sizes in the order given."""
    tree, used = RoomTree(len(sizes), capacity), [0] * len(sizes)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        at = tree.first_fit(size)
        bins[i], offsets[i] = at, used[at]
        used[at] += size
    return bins, offsets


def token_pieces(docs: DataFrame, *, tokenizer: str, capacity: int, end_id: int = 0, with_ids: bool = False, remembered: int = REMEMBERED_BYTES) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``): documents as pieces of at most ``capacity`` ids."""
    rows = id_and_text(docs)
    schema = f"doc_id {type_of(rows, 'doc_id')}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, remembered).encode
        for batch in pieces(batches):
            ids, counts = encode(strings(batch.column("text")))
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype("<u4")
            totals = counts + 1
            begins = np.cumsum(totals) - totals
            parts = -(-totals // capacity)
            row = np.repeat(np.arange(len(totals)), parts)
            start = (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)) * capacity
            length = np.minimum(totals[row] - start, capacity)
            first = begins[row] + start
            bounds = list(zip(first.tolist(), (first + length).tolist()))
            columns = [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(start),
                pa.array(length),
                pa.array([zlib.crc32(ids[a:b]) for a, b in bounds], pa.int64()),
                pa.array(totals[row]),
            ]
            if with_ids:
                columns.append(pa.array([ids[a:b].astype(np.int32) for a, b in bounds], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def pack(
    docs: DataFrame,
    *,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    end_id: int = 0,
    seed: int = 1,
    with_ids: bool = False,
    remembered: int = REMEMBERED_BYTES,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    A document's ids are its text's and ``end_id``; a null or empty text is ``end_id``
    alone. Pieces cut a document without gap or overlap, ``offset`` runs without gap from 0 in
    each sequence, and no sequence is longer than ``capacity``. Repeated rows and ids are
    packed row by row; an empty table gives no rows; other columns of ``docs`` aren't read.
    ``tokenizer`` is the path of a file of the tokenizers library; a worker keeps at most about ``remembered`` bytes of encoded words.
    """
    found = token_pieces(docs, tokenizer=tokenizer or public_path(), capacity=capacity, end_id=end_id, with_ids=with_ids, remembered=remembered)
    table = stored(found, "pieces")  # the texts are encoded once
    groups = max(1, -(-table.count() // group_pieces))
    dealt = table.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(groups)))
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields]

    def place(group: pa.Table) -> pa.Table:
        group = group.sort_by([("start", "ascending"), ("doc_id", "ascending"), ("ids_crc32", "ascending")])
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), capacity)
        number = group.column("group")[0].as_py()
        group = group.drop_columns(["group"])
        return group.append_column("sequence_id", pa.array(number * _BINS + bins)).append_column("offset", pa.array(offsets))

    return dealt.groupBy("group").applyInArrow(place, ", ".join([*kept, "sequence_id bigint", "offset bigint"]))
