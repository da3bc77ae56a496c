"""Token ids on disk: canonical Huffman codes of limited length, in blocks that decode on their own.

A token file is a folder of Parquet tables, so any store that Spark reads can hold it:

* ``code``: ``id, bits`` - code lengths from the counts of all ids; canonical, so lengths are all it takes;
* ``blocks/part=N``: ranges of documents in ascending order of their ids; a row is a block of some ten
  thousand ids: ``block``, ``base`` (ids of the part before it), ``doc_ids``, ``doc_tokens``, ``payload``
  (the codes, most significant bit first) and ``checkpoints`` (bit offset of every 256th id);
* ``parts``: ``part, before`` - ids in all parts before it.

Checkpoints make decoding parallel within a block: numpy decodes all stretches of a batch in
step, one table look-up for one id of each of thousands of stretches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprep.llm.shared import forget, id_and_text, pieces, stored, strings, type_of
from tabprep.llm.tokens import encoder, public_path

MAX_BITS = 16
BLOCK_IDS = 1 << 16
STRETCH = 256


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``max_bits`` bits, by package-merge; 0 where the count is 0."""
    present = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    n = len(present)
    if n < 2:
        lengths[present] = 1
        return lengths
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need more than {max_bits} bits")
    order = present[np.argsort(counts[present], kind="stable")]
    weights = counts[order].astype(np.float64)  # exact below 2**53
    level, single = weights, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        even = len(level) // 2 * 2
        merged = np.concatenate([weights, level[:even:2] + level[1:even:2]])
        by_weight = np.argsort(merged, kind="stable")
        level = merged[by_weight]
        single.append(by_weight < n)
    take, per_item = 2 * n - 2, np.zeros(n, np.int64)
    for items in reversed(single):
        light = int(items[:take].sum())
        per_item[:light] += 1
        take = 2 * (take - light)
    lengths[order] = per_item
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)).tolist():
        bits = int(lengths[i])
        if bits:
            code <<= bits - before
            codes[i], before = code, bits
            code += 1
    return codes


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Payload (in whole 32-bit words) and bit offset of every ``STRETCH``-th id."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    bits = lengths[ids]
    ends = np.cumsum(bits)
    at = ends - bits
    word, shift = at >> 5, at & 31
    shifted = codes[ids] << (64 - shift - bits).astype(np.uint64)
    out = np.zeros((int(ends[-1]) + 31) // 32 + 1, np.uint64)
    firsts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out[word[firsts]] |= np.add.reduceat(shifted >> np.uint64(32), firsts)
    out[word[firsts] + 1] |= np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), firsts)
    return out[: (int(ends[-1]) + 31) // 32].astype(">u4").tobytes(), at[::STRETCH]


class Decoder:
    """One look-up gives the id and the length of the code that the next bits begin with."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.bits = max(1, int(lengths.max(initial=1)))
        codes = canonical_codes(lengths)
        present = np.flatnonzero(lengths)
        first = (codes[present] << (self.bits - lengths[present]).astype(np.uint64)).astype(np.int64)
        order = np.argsort(first)
        spans = np.append(first[order][1:], 1 << self.bits) - first[order] if len(order) else np.zeros(0, np.int64)
        self.ids = np.repeat(present[order], spans).astype(np.int32)
        self.steps = np.repeat(lengths[present[order]], spans)
        if len(order) == 1:  # a lone code is one bit; the other bit never occurs
            self.ids, self.steps = np.full(1 << self.bits, present[0], np.int32), np.ones(1 << self.bits, np.int64)

    def decode(self, payloads: list[bytes], checkpoints: list[np.ndarray], counts: list[int]) -> np.ndarray:
        """The ids of blocks, one block after the other."""
        words = np.frombuffer(b"".join(payloads) + bytes(STRETCH * MAX_BITS // 4 + 64), ">u4").astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        starts = np.cumsum([0] + [len(p) * 8 for p in payloads])[:-1]
        at = np.concatenate([c + s for c, s in zip(checkpoints, starts)]) if payloads else np.zeros(0, np.int64)
        out = np.zeros((STRETCH, len(at)), np.int32)
        top, mask = 64 - self.bits, (1 << self.bits) - 1
        last = len(pairs) - 1
        for step in range(STRETCH if len(at) else 0):
            window = pairs[np.minimum(at >> 5, last)] >> (top - (at & 31)).astype(np.uint64)
            window = window.astype(np.int64) & mask
            out[step] = self.ids[window]
            at = at + self.steps[window]
        flat = out.T.reshape(-1)
        stretches = np.array([len(c) for c in checkpoints], np.int64)
        ends = np.cumsum(stretches) * STRETCH
        begins = ends - stretches * STRETCH
        return np.concatenate([flat[b : b + n] for b, n in zip(begins.tolist(), counts)]) if payloads else flat


_BLOCK = "block bigint, base bigint, doc_ids array<{}>, doc_tokens array<bigint>"


def write_token_file(
    docs: DataFrame,
    folder: str,
    *,
    tokenizer: str | None = None,
    end_id: int = 0,
    max_bits: int = MAX_BITS,
    block_ids: int = BLOCK_IDS,
) -> str:
    """Write the ids of all documents, each closed by ``end_id``, in ascending order of ``doc_id``; gives the folder.

    Null ids come first, equal ids in order of the text. A null or empty text is
    ``end_id`` alone; an empty table gives a file without blocks. Other columns aren't read.
    The texts are encoded once; their ids wait in the shared folder until the counts of all are known.
    """
    spark = docs.sparkSession
    path = tokenizer or public_path()
    vocabulary = max(encoder(path).vocabulary, end_id + 1)
    kind = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
    rows = id_and_text(docs)
    block = _BLOCK.format(type_of(rows, "doc_id"))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path).encode, TaskContext.get().partitionId()
        counts, base, number = np.zeros(vocabulary, np.int64), 0, 0
        names = ["part", "block", "base", "doc_ids", "doc_tokens", "ids", "id", "n"]
        id_list = None
        for batch in pieces(batches):
            ids, sizes = encode(strings(batch.column("text")))
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            counts += np.bincount(ids, minlength=vocabulary)
            sizes = sizes + 1
            ends = np.cumsum(sizes)
            doc_ids = batch.column("doc_id")
            id_list = pa.list_(doc_ids.type)
            cuts = [0, *(np.flatnonzero(np.diff((ends - sizes) // block_ids)) + 1).tolist(), len(sizes)]
            for a, b in zip(cuts, cuts[1:]):
                begin, stop = int(ends[a] - sizes[a]), int(ends[b - 1])
                one = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), doc_ids.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([number], pa.int64()),
                        pa.array([base], pa.int64()),
                        one,
                        pa.array([sizes[a:b]], pa.list_(pa.int64())),
                        pa.array([ids[begin:stop].astype(kind).tobytes()], pa.binary()),
                        pa.nulls(1, pa.int32()),
                        pa.nulls(1, pa.int64()),
                    ],
                    names=names,
                )
                base, number = base + stop - begin, number + 1
        seen = np.flatnonzero(counts)
        if len(seen):
            blank = [pa.nulls(len(seen), t) for t in (pa.int64(), pa.int64(), id_list, pa.list_(pa.int64()), pa.binary())]
            own = [pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), part), pa.int32()), *blank, *own], names=names)

    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    waiting = stored(ordered.mapInArrow(tokenize, f"part int, {block}, ids binary, id int, n bigint"), "ids", compression="zstd")
    counts = np.zeros(vocabulary, np.int64)
    # One row per id of the vocabulary.
    for row in waiting.where("id IS NOT NULL").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n
    lengths = code_lengths(counts, max(max_bits, int(np.count_nonzero(counts)).bit_length()))
    codes = canonical_codes(lengths)
    present = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(present, "id int, bits int").coalesce(1).write.parquet(f"{folder}/code")

    def encode_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [encode_block(np.frombuffer(b, kind).astype(np.int64), codes, lengths) for b in batch.column("ids").to_pylist()]
            batch = batch.drop_columns(["ids"])
            payload = pa.array([m[0] for m in made], pa.binary())
            marks = pa.array([m[1].astype(np.int32) for m in made], pa.list_(pa.int32()))
            yield batch.append_column("payload", payload).append_column("checkpoints", marks)

    blocks = waiting.where("block IS NOT NULL").drop("id", "n")
    encoded = blocks.mapInArrow(encode_blocks, f"part int, {block}, payload binary, checkpoints array<int>")
    encoded.write.partitionBy("part").parquet(f"{folder}/blocks")
    # One row per part of the file.
    sizes = waiting.where("id IS NOT NULL").groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before = np.cumsum([0] + [r.n for r in sizes]).tolist()
    spark.createDataFrame([(r.part, b) for r, b in zip(sizes, before)], "part int, before bigint").coalesce(1).write.parquet(f"{folder}/parts")
    schema = spark.createDataFrame([], f"{block}, payload binary, checkpoints array<int>, part int").schema
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.parquet(f"{folder}/schema")
    forget(waiting)
    return folder


def read_token_file(spark: SparkSession, folder: str, *, with_ids: bool = False) -> DataFrame:
    """One row per document of the file: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``).

    ``start`` is the number of ids of all documents before it; ``ids_crc32`` is taken of the
    decoded ids as little-endian 32-bit integers.
    """
    import json

    from pyspark.sql.types import StructType

    schema = StructType.fromJson(json.loads(spark.read.parquet(f"{folder}/schema").first().schema))
    code = spark.read.parquet(f"{folder}/code").collect()  # at most one row per id of the vocabulary
    lengths = np.zeros(max((r.id for r in code), default=0) + 1, np.int64)
    for row in code:
        lengths[row.id] = row.bits
    id_type = schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(lengths)
        for batch in batches:
            sizes = [np.array(x, np.int64) for x in batch.column("doc_tokens").to_pylist()]
            firsts = [b + p for b, p in zip(batch.column("base").to_pylist(), batch.column("before").to_pylist())]
            marks = [np.array(x, np.int64) for x in batch.column("checkpoints").to_pylist()]
            payloads = batch.column("payload").to_pylist()
            # Some blocks at a time: the stretches of a million ids are decoded in step.
            begin = 0
            while begin < len(payloads):
                stop, held = begin, 0
                while stop < len(payloads) and (stop == begin or held + int(sizes[stop].sum()) <= 1 << 21):
                    held += int(sizes[stop].sum())
                    stop += 1
                yield rows(decoder, batch.slice(begin, stop - begin), sizes[begin:stop], firsts[begin:stop], marks[begin:stop], payloads[begin:stop])
                begin = stop

    def rows(decoder: Decoder, batch: pa.RecordBatch, sizes: list, firsts: list, marks: list, payloads: list) -> pa.RecordBatch:
        ids = decoder.decode(payloads, marks, [int(s.sum()) for s in sizes]).astype("<u4")
        tokens = np.concatenate(sizes)
        ends = np.cumsum(tokens)
        bounds = list(zip((ends - tokens).tolist(), ends.tolist()))
        columns = [
            batch.column("doc_ids").flatten(),
            pa.array(np.concatenate([np.cumsum(s) - s + f for s, f in zip(sizes, firsts)])),
            pa.array(tokens),
            pa.array([zlib.crc32(ids[a:b]) for a, b in bounds], pa.int64()),
        ]
        if with_ids:
            columns.append(pa.array([ids[a:b].astype(np.int32) for a, b in bounds], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    parts = spark.read.parquet(f"{folder}/parts")
    out = f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    if parts.isEmpty():
        return spark.createDataFrame([], out)
    blocks = spark.read.schema(schema).parquet(f"{folder}/blocks")
    # One row per part, so its size has nothing to do with the number of documents.
    return blocks.join(F.broadcast(parts), "part").drop("part", "block").mapInArrow(decode, out)
