"""Context-triggered piecewise hashing of documents.

A rolling hash over seven bytes ends a chunk wherever it is congruent to -1 modulo the
block size (3, 6, 12, ...); each chunk contributes one of 64 characters, and the
characters of the chunks at two neighbouring block sizes are the signature. An edit
changes the characters of the chunks it touches and no others, so two documents are as
like as their signatures are close in edit distance, compared at equal block sizes.

The hashes of all bytes of a batch are computed at once in numpy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.shared import id_and_text, pieces, stored, strings, type_of

_SPAN = 7  # bytes the rolling hash sees
_FEW, _AIM, _MANY = 32, 64, 128  # characters of a signature: at least (if a smaller block size gives them), about, at most
_LEVELS = 31
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_RATIO = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SHARD = 2 << 20
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the ratio and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_RATIO, pow(_RATIO, -1, 1 << 64))):
            steps = np.full(max(n, _SHARD + (1 << 16)), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def _rolling(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, from the byte and the six before it."""
    n = len(data) - _SPAN
    c = data.astype(np.uint32)
    sums = np.cumsum(c, dtype=np.uint32)
    plain = sums[_SPAN:] - sums[:-_SPAN]
    weighted = np.cumsum(c * np.arange(len(c), dtype=np.uint32), dtype=np.uint32)
    hash_ = (np.uint32(_SPAN) - np.arange(_SPAN, len(c), dtype=np.uint32)) * plain
    hash_ += weighted[_SPAN:] - weighted[:-_SPAN]
    hash_ += plain
    two = c[1:] ^ (c[:-1] << np.uint32(5))
    four = two[2:] ^ (two[:-2] << np.uint32(10))
    hash_ += four[4 : 4 + n] ^ (two[2 : 2 + n] << np.uint32(20)) ^ (c[1 : 1 + n] << np.uint32(30))
    return hash_


def signatures(texts: list[bytes]) -> list[str]:
    """The fingerprint of each text: ``block size:characters:characters at twice the block size``.

    The block size is the largest that gives 32 characters or so. An empty text has the
    fingerprint ``3::``.
    """
    if not texts:
        return []
    gap = bytes(_SPAN)
    data = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    sizes = np.array([len(t) for t in texts])
    begins = _SPAN + np.cumsum(sizes + _SPAN) - sizes - _SPAN
    ends = begins + sizes
    marks = _rolling(data)
    at = np.flatnonzero(marks % np.uint32(3) == 2) + _SPAN
    owner = np.searchsorted(begins, at, "right") - 1
    inside = (owner >= 0) & (at < ends[owner] - 1)  # the last byte ends a chunk anyway
    at, owner = at[inside], owner[inside]
    multiple = (marks[at - _SPAN].astype(np.int64) + 1) // 3
    level = np.minimum(np.log2((multiple & -multiple).astype(np.float64)).astype(np.int64), _LEVELS - 1)
    per_level = np.bincount(owner * _LEVELS + level, minlength=len(texts) * _LEVELS).reshape(-1, _LEVELS)
    reach = np.cumsum(per_level[:, ::-1], axis=1)[:, ::-1]  # boundaries at this block size
    chosen = np.ceil(np.log2(np.maximum(sizes / (3 * _AIM), 1))).astype(np.int64)
    rows = np.arange(len(texts))
    for _ in range(_LEVELS):
        now = reach[rows, chosen]
        lower = (now < _FEW) & (chosen > 0) & (reach[rows, np.maximum(chosen - 1, 0)] <= _MANY)
        if not lower.any():
            break
        chosen = chosen - lower
    for _ in range(_LEVELS):
        higher = (reach[rows, chosen] > _MANY) & (chosen < _LEVELS - 1)
        if not higher.any():
            break
        chosen = chosen + higher
    powers, inverses = _power_tables(len(data))
    sums = np.cumsum(data * powers[: len(data)], dtype=np.uint64)
    halves = []
    for k in (chosen, chosen + 1):
        cut = level >= k[owner]
        stop = np.concatenate([at[cut], ends[sizes > 0] - 1])
        of = np.concatenate([owner[cut], rows[sizes > 0]])
        order = np.argsort(stop, kind="stable")
        stop, of = stop[order], of[order]
        first = np.concatenate([[True], of[1:] != of[:-1]])[: len(of)]
        start = np.where(first, begins[of], np.concatenate([[0], stop[:-1] + 1])[: len(stop)])
        value = (sums[stop] - sums[start - 1]) * inverses[start]
        value = ((value ^ (value >> np.uint64(29))) * _MIX) >> np.uint64(58)
        letters = _LETTERS[value.astype(np.int64)].tobytes().decode()
        counts = np.bincount(of, minlength=len(texts))
        bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
        halves.append([letters[a:b] for a, b in zip(bounds, bounds[1:])])
    return [f"{3 << k}:{a}:{b}" for k, a, b in zip(chosen.tolist(), *halves)]


def edit_distance(a: str, b: str) -> int:
    """Fewest insertions, deletions and replacements, with the columns of the table as bits of an integer."""
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    a, b = a[same:], b[same:]
    if not a or not b:
        return len(a) + len(b)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    up, down, score = full, 0, len(a)
    for y in b:
        match = where.get(y, 0)
        level = (((match & up) + up) ^ up) | match | down
        more = down | (~(level | up) & full)
        less = up & level
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more = more << 1 | 1
        up = (less << 1 | ~(level | more)) & full
        down = more & level & full
    return score


def likeness(one: str, other: str) -> float:
    """From 0 to 1: 1 less the edit distance per character, at the block sizes both have; 0 if they have none."""
    if one == other:
        return 1.0
    size_a, a1, a2 = one.split(":")
    size_b, b1, b2 = other.split(":")
    if size_a == size_b:
        couples = ((a1, b1), (a2, b2))
    elif int(size_a) == 2 * int(size_b):
        couples = ((a1, b2),)
    elif int(size_b) == 2 * int(size_a):
        couples = ((a2, b1),)
    else:
        return 0.0
    longest = sum(max(len(a), len(b)) for a, b in couples)
    return 1.0 - sum(edit_distance(a, b) for a, b in couples) / longest if longest else 1.0


def fingerprints(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` for each row, in place. Null texts count as empty; equal texts have equal fingerprints."""
    rows = id_and_text(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=_SHARD):
            made = signatures([t.encode() for t in strings(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {type_of(rows, 'doc_id')}, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: list, texts: list[str], following: list[str]) -> list[list]:
    """Columns of the result for documents and the ones after them."""
    changed = [edited(t, f) for t, f in zip(texts, following)]
    own, theirs, new = (signatures([t.encode() for t in many]) for many in (texts, following, changed))
    return [
        ids,
        [len(t) for t in texts],
        [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        own,
        new,
        [likeness(a, b) for a, b in zip(own, new)],
        [likeness(a, b) for a, b in zip(own, theirs)],
    ]


def neighbour_likeness(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each document compared with the next by id, and with itself after half of it was replaced by the next.

    Rows: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    After the last document comes the first. Rows are ordered by id, nulls first, and
    equal ids by text. Null texts count as empty. An empty table gives no rows; a single
    document follows itself. Only columns id and text are read, so others can't clash.

    The texts are shuffled once, by ranges of the id. Each range is a stream in which every row
    is compared with the one before, so a task holds a few MB whatever the range holds. The
    first and last row of each range are put aside and joined range by range afterwards.
    """
    rows = id_and_text(docs, id_column, text_column)
    kind = type_of(rows, "doc_id")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    kinds = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def arrays(columns: list, id_type: pa.DataType) -> list[pa.Array]:
        return [pa.array(c, t or id_type) for c, t in zip(columns, kinds)]

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, id_type = None, None

        def edge(role: str, doc_id: object, text: str) -> pa.RecordBatch:
            empty = [pa.nulls(1, t) for t in kinds[1:]]
            own = [pa.array([part], pa.int32()), pa.array([role]), pa.array([text])]
            return pa.RecordBatch.from_arrays([pa.array([doc_id], id_type), *empty, *own], names=[*names, "part", "role", "edge"])

        for batch in pieces(batches, limit=_SHARD):
            id_type = batch.column("doc_id").type
            ids, texts = batch.column("doc_id").to_pylist(), strings(batch.column("text"))
            if last is None:
                yield edge("first", ids[0], texts[0])
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            last = ids[-1], texts[-1]
            made = arrays(_compared(ids[:-1], texts[:-1], texts[1:]), id_type)
            n = len(ids) - 1
            if n:
                blank = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())]
                yield pa.RecordBatch.from_arrays([*made, *blank], names=[*names, "part", "role", "edge"])
        if last is not None:
            yield edge("last", *last)

    ranges = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    table = stored(ranges.mapInArrow(within, f"{schema}, part int, role string, edge string"), "fingerprints")
    # One row per range of the shuffle, whatever the number of documents.
    parts = sorted(r.part for r in table.where("role = 'first'").select("part").collect())
    after = list(zip(parts, [*parts[1:], *parts[:1]]))
    order = table.sparkSession.createDataFrame(after, "part int, next_part int")
    lasts = table.where("role = 'last'").select("part", "doc_id", F.col("edge").alias("text"))
    firsts = table.where("role = 'first'").select(F.col("part").alias("next_part"), F.col("edge").alias("following"))
    pairs = lasts.join(F.broadcast(order), "part").join(firsts, "next_part").select("doc_id", "text", "following")

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=_SHARD):
            columns = _compared(batch.column("doc_id").to_pylist(), strings(batch.column("text")), strings(batch.column("following")))
            yield pa.RecordBatch.from_arrays(arrays(columns, batch.column("doc_id").type), names=names)

    return table.where("role IS NULL").select(*names).union(pairs.mapInArrow(between, schema))
