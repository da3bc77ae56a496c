"""SimHash near-duplicates: fingerprints, then all links within a few bits by the generalised pigeonhole principle.

If the bits are divided into ``m`` parts with thresholds that sum to ``distance - m + 1``, then any
two fingerprints within ``distance`` bits differ by no more than its threshold in one
part at least (a threshold of -1 leaves a part out). So each fingerprint is put under its value in each part, and
under the values that differ in up to the threshold's number of bits; whoever may link meets there.
Bits that go together are grouped in one part, and a dynamic program gives the parts
unequal thresholds by the number of candidates it expects, estimated from how often all fingerprints have each
pair of bits. More fingerprints mean fewer and wider parts.

Equal fingerprints are one node. What meets under a value is verified in numpy, and a bucket yields
no pairs but a spanning forest of its links: at most one row for each of its members. Buckets
too large for a task are dealt out in blocks, each pair of blocks to a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.shared import forget, id_and_text, pieces, raw_bytes, stored, type_of

BITS = 64
SHINGLE = 3
DISTANCE = 3
SEED = 42
BROADCAST_ROWS = 500_000  # ids and hashes of rows to be dropped, 16 bytes each
BLOCK = 4096  # members of a bucket that are compared in one task
_POPULAR = np.array([bin(i).count("1") for i in range(256)], np.int64)
_BIT_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the words of ``text`` (A-Z lower-cased) in shingles; 0 without words.

    A bit is 1 if over half the shingles' 64-bit hashes have it; repeats count.
    """
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n <= 1:
        return xxh64_intdigest(b" ".join(words), SEED)
    if shingle == 3:
        hashes = [xxh64_intdigest(b"%b %b %b" % w, SEED) for w in zip(words, words[1:], words[2:])]
    else:
        hashes = [xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(n)]
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(n, 8)
    value = 0
    for i in range(8):
        ones = np.bincount(octets[:, i], minlength=256) @ _BIT_OF_BYTE
        value |= sum(1 << (8 * i + b) for b in np.flatnonzero(2 * ones > n).tolist())
    return value


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text_hash, fingerprint``: the fingerprint as a signed 64-bit integer, and a hash that tells texts apart."""
    rows = id_and_text(docs, id_column, text_column).withColumn("text_hash", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            made = np.array([fingerprint(t, shingle) for t in raw_bytes(batch.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(made)], names=["doc_id", "text_hash", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {type_of(rows, 'doc_id')}, text_hash bigint, fingerprint bigint")


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and how many have both bit i and bit j (64 x 64), over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for begin in range(0, len(values), 1 << 15):
                some = values[begin : begin + (1 << 15)]
                bits = ((some[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
                n += len(some)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1), pa.int32()), pa.array([*both.reshape(-1), n], pa.int64())], names=["cell", "n"])

    # 64 x 64 + 1 rows, summed by Spark.
    rows = prints.select("fingerprint").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for row in rows:
        cells[row.cell] = row.n
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in parts of equal size; each part takes the bit most correlated with those it has."""
    share = both / max(n, 1)
    mean = np.diag(share)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    related = np.abs((share - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        first = max(left, key=lambda b: (max(related[b, c] for c in left), -b))
        own = [first]
        left.remove(first)
        while len(own) < size:
            best = max(left, key=lambda b: (related[b, own].sum(), -b))
            own.append(best)
            left.remove(best)
        groups.append(own)
    return groups


def difference_chances(n: int, both: np.ndarray, bits: list[int], most: int) -> np.ndarray:
    """Chance that two fingerprints differ in 0, 1, ... ``most`` of ``bits``, each bit depending on the one before."""
    share, mean = both / max(n, 1), np.diag(both) / max(n, 1)
    state = np.zeros((most + 1, 2))  # by differences so far, and whether the last bit differs
    p = mean[bits[0]]
    state[0, 0] = p * p + (1 - p) ** 2
    if most:
        state[1, 1] = 2 * p * (1 - p)
    for a, b in zip(bits, bits[1:]):
        p11, p10, p01 = share[a, b], mean[a] - share[a, b], mean[b] - share[a, b]
        p00 = max(0.0, 1 - p11 - p10 - p01)
        same_same = p00 * p00 + p01 * p01 + p10 * p10 + p11 * p11
        same_other = 2 * (p00 * p01 + p10 * p11)
        other_same = 2 * (p00 * p10 + p01 * p11)
        other_other = 2 * (p00 * p11 + p01 * p10)
        after_same, after_other = max(same_same + same_other, 1e-18), max(other_same + other_other, 1e-18)
        new = np.zeros_like(state)
        new[:, 0] = state[:, 0] * same_same / after_same + state[:, 1] * other_same / after_other
        new[1:, 1] = state[:-1, 0] * same_other / after_same + state[:-1, 1] * other_other / after_other
        state = new
    return state.sum(axis=1)


#: Cost of a row that is shuffled and sorted, in compared pairs.
_ROW = 400.0


def allocate(n: int, chances: list[np.ndarray], sizes: list[int], distance: int) -> tuple[float, list[int]]:
    """Thresholds of the parts that sum to ``distance - parts + 1`` at the least expected cost, by dynamic programming."""
    parts = len(chances)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for chance, size in zip(chances, sizes):
        new: dict[int, tuple[float, list[int]]] = {}
        rows, pairs = 0.0, 0.0
        for threshold in range(-1, distance + 1):
            if threshold >= 0:
                rows += float(np.prod([size - i for i in range(threshold)]) / np.prod(range(1, threshold + 1)))
                pairs = float(chance[: threshold + 1].sum())
            cost = n * rows * _ROW + n * n * pairs / 2 * max(rows, 1.0) if threshold >= 0 else 0.0
            for total, (sum_, chosen) in best.items():
                if total + threshold not in new or sum_ + cost < new[total + threshold][0]:
                    new[total + threshold] = sum_ + cost, [*chosen, threshold]
        best = new
    return best[distance - parts + 1]


def plan(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """Parts and their thresholds: the division with the least expected cost."""
    choices = []
    for parts in range(1, distance + 2):
        groups = group_bits(n, both, parts)
        chances = [difference_chances(n, both, g, distance) for g in groups]
        cost, thresholds = allocate(n, chances, [len(g) for g in groups], distance)
        choices.append((cost, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]))
    return min(choices, key=lambda c: c[0])[1]


def _near(values: np.ndarray, one: np.uint64, distance: int) -> np.ndarray:
    return np.bitwise_count(values ^ one) <= distance


def spanning_links(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among distinct values: (index, index) of a forest."""
    left = np.arange(len(values))
    links: list[tuple[int, int]] = []
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        stack = [root]
        while stack and len(left):
            one = stack.pop()
            near = _near(values[left], values[one], distance)
            found = left[near].tolist()
            if found:
                left = left[~near]
                links += [(root, f) for f in found]
                stack += found
    return links


def _bucket_links(keys: np.ndarray, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links in each run of equal keys (sorted, values distinct in a run)."""
    bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(bounds)
    one, other = [], []
    first = bounds[:-1][sizes == 2]  # most buckets: two members, compared all at once
    near = np.bitwise_count(values[first] ^ values[first + 1]) <= distance
    one.append(values[first[near]])
    other.append(values[first[near] + 1])
    for begin, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        own = values[begin : begin + size]
        links = spanning_links(own, distance)
        if links:
            index = np.array(links)
            one.append(own[index[:, 0]])
            other.append(own[index[:, 1]])
    return np.concatenate(one), np.concatenate(other)


def links(prints: DataFrame, *, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect all that lie within ``distance`` bits.

    ``prints`` has a column ``fingerprint``, each value once. Every link of the full graph lies inside a
    connected component of the result, and every row of the result is a link or joins two ends of a chain of links.
    """
    n, both = bit_statistics(prints)
    parts = plan(n, both, distance)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for number, (bits, threshold) in enumerate(parts):
                own = np.zeros(len(values), np.uint64)
                for i, bit in enumerate(bits):
                    own |= ((values >> np.uint64(bit)) & np.uint64(1)) << np.uint64(i)
                for flips in range(threshold + 1):
                    for chosen in combinations(range(len(bits)), flips):
                        key = own ^ np.uint64(sum(1 << i for i in chosen))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(key), number, np.int32)), pa.array(key.view(np.int64)), pa.array(values.view(np.int64))],
                            names=["part", "key", "fingerprint"],
                        )

    probes = stored(prints.select("fingerprint").mapInArrow(probe, "part int, key bigint, fingerprint bigint"), "probes")
    crowded = probes.groupBy("part", "key").agg(F.count("*").alias("members")).where(F.col("members") > block)
    crowded = crowded.withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    # A member of a crowded bucket goes to the tasks of all pairs of blocks that have its own block.
    mine = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(j, mine) * F.col("blocks") + F.greatest(j, mine))
    dealt = probes.join(crowded, ["part", "key"], "left").withColumn("pair", F.explode(F.coalesce(pair, F.array(F.lit(0)))))
    dealt = dealt.select("part", "key", "pair", "fingerprint")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0

        def flush(rows: list[pa.RecordBatch], last: bool) -> tuple[pa.RecordBatch | None, list[pa.RecordBatch]]:
            table = pa.Table.from_batches(rows).combine_chunks()
            columns = [table.column(c).to_numpy() for c in ("part", "key", "pair", "fingerprint")]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)) + 1
            end = table.num_rows if last else int(change[-1]) if len(change) else 0
            if not end:
                return None, [table.to_batches()[0]]
            group = np.zeros(end, np.int64)
            group[change[change < end]] = 1
            a, b = _bucket_links(np.cumsum(group), columns[3][:end].view(np.uint64), distance)
            rest = table.slice(end).combine_chunks().to_batches() if end < table.num_rows else []
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]), rest

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count >= 1 << 17:
                out, held = flush(held, False)
                count = sum(b.num_rows for b in held)
                if out is not None:
                    yield out
        if held:
            out, _ = flush(held, True)
            if out is not None:
                yield out

    met = dealt.repartition("part", "key", "pair").sortWithinPartitions("part", "key", "pair")
    found = stored(met.mapInArrow(compare, "a bigint, b bigint").distinct(), "links")
    forget(probes)
    return found


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that each node of ``a, b`` is connected with.

    Alternates two steps on (larger, smaller) edges until nothing changes: each node
    links its larger neighbours to its smallest one, then its smaller neighbours to the smallest one.
    Grouping by the node keeps one edge per neighbour; minima are combined before each shuffle,
    and joins on a hot node are split by Spark.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    while True:
        # Large star.
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "edges")
        # Small star.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        small = stored(small, "edges")
        same = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count("*")
        before, after = now.agg(*same).first(), small.agg(*same).first()
        forget(large)
        forget(now)
        now = small
        if tuple(before) == tuple(after):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    id_column: str = "doc_id",
    text_column: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, text_hash, fingerprint, group, component_id`` for each row of ``docs``.

    Rows whose fingerprints lie within ``distance`` bits are linked; ``component_id`` is the smallest
    ``doc_id`` that can be reached over links (null if all ids reached are null), ``group`` a
    fingerprint that names the component even where ids are null or repeat. Texts
    without words, nulls too, have the fingerprint 0 and link like any other. Repeated rows are
    rows of one component. An empty table gives no rows; other columns aren't read.
    """
    prints = stored(fingerprints(docs, shingle=shingle, id_column=id_column, text_column=text_column), "fingerprints")
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fingerprint"), distance=distance, block=block))
    rooted = distinct.join(roots, distinct.fingerprint == roots.node, "left")
    rooted = stored(rooted.select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(least, "root").select("fingerprint", F.col("root").alias("group"), "component_id")
    # A fingerprint that very many rows share is split by Spark's skew join.
    return prints.join(by_print, "fingerprint").select("doc_id", "text_hash", "fingerprint", "group", "component_id")


def keep_one(
    docs: DataFrame,
    *,
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    id_column: str = "doc_id",
    text_column: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, with all its columns, whatever their names: the one with the smallest id.

    If several rows have that id, one with the smallest hash of the text stays. Ids and hashes alone decide. If at most
    ``broadcast_rows`` of them are to go, they are sent to the texts, else texts and verdicts meet in one shuffle.
    """
    found = near_duplicates(docs, shingle=shingle, distance=distance, id_column=id_column, text_column=text_column)
    keys = found.groupBy("doc_id", "text_hash", "group").agg(F.count("*").alias("n"))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    verdicts = keys.join(keys.groupBy("group").agg(F.min(own).alias("first")), "group")
    verdicts = stored(verdicts.select(F.col("doc_id").alias("id"), "text_hash", "n", (own == F.col("first")).alias("kept")), "verdicts")
    gone, repeated = verdicts.agg(F.count_if(~F.col("kept")), F.count_if(F.col("kept") & (F.col("n") > 1))).first()

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_column, text_column))
    hashed = plain.withColumn("own", F.xxhash64(text.cast("string")))

    def meets(side: DataFrame) -> Column:
        return (F.col("own") == side["text_hash"]) & doc_id.eqNullSafe(side["id"])

    if gone <= broadcast_rows:
        drop = verdicts.where("NOT kept")
        rows = hashed.join(F.broadcast(drop), meets(drop), "left_anti")
    else:
        keep = verdicts.where("kept")
        rows = hashed.join(keep, meets(keep), "left_semi")
    if repeated:
        # Only rows that are there several times are compared once more.
        many = verdicts.where("kept AND n > 1")
        once = rows.join(many, meets(many), "left_anti")
        rows = once.unionAll(rows.join(many, meets(many), "left_semi").dropDuplicates(["own", f"c{docs.columns.index(id_column)}"]))
    return rows.drop("own").toDF(*docs.columns)
